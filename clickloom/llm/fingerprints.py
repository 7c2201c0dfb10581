"""Document fingerprints by one-permutation MinHash.

Each shingle of five words is hashed once; the high bits of the hash name one of 256 bins, and a
bin keeps its least hash. An empty bin takes the value of the first bin that is not empty in an
order of bins that hangs on its own number only (optimal densification). The four low bits of all
bins are the fingerprint, one hexadecimal digit for each bin. Two different values agree in their
low bits one time in 16, which the likeness takes out. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordering import with_row_index
from clickloom.session import freeze

#: Bins and bits kept of each; words of a shingle; bins an empty bin tries before it ranks all.
BINS, BITS, WORDS, TRIES = 256, 4, 5, 8
EMPTY = "."


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the fingerprint of column ``text``: 256 hexadecimal digits, or the empty
    string for NULL, empty and blank texts. Fewer than five words are one shingle."""
    words, hashes, sortd, least, bins = (f"__{k}_{name}" for k in ("w", "h", "s", "m", "b"))
    tries = ", ".join(
        f"nullif(substring({bins}, pmod(xxhash64(i, {t}), {BINS}) + 1, 1), '{EMPTY}')"
        for t in range(TRIES)
    )
    digit = lambda h: f"lower(hex({h} & {2**BITS - 1}))"
    shift = 64 - (BINS - 1).bit_length()
    number = lambda h: f"(shiftright({h}, {shift}) + {BINS // 2})"
    shingle = ", ".join(f"{words}[i + {k}]" for k in range(WORDS))
    steps = {
        words: f"""transform(filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''), w -> xxhash64(w))""",
        hashes: f"""case when size({words}) >= {WORDS}
            then transform(sequence(0, size({words}) - {WORDS}), i -> xxhash64({shingle}))
            when size({words}) > 0 then array(xxhash64({words})) else cast(array() as array<bigint>) end""",
        sortd: f"sort_array({hashes})",
        least: f"""filter({sortd}, (h, i) -> i = 0
            or shiftright(h, {shift}) <> shiftright({sortd}[i - 1], {shift}))""",
        # bins in order, gaps filled with a mark
        bins: f"""concat(array_join(transform({least}, (h, i) -> concat(
            repeat('{EMPTY}', cast({number('h')} - if(i = 0, 0, {number(f'{least}[i - 1]')} + 1) as int)),
            {digit('h')})), ''), repeat('{EMPTY}', cast({BINS - 1} - {number(f'try_element_at({least}, -1)')} as int)))""",
        name: f"""case when size({least}) = 0 or {least} is null then ''
            when instr({bins}, '{EMPTY}') = 0 then {bins}
            else array_join(transform(sequence(0, {BINS - 1}), i -> coalesce(
                nullif(substring({bins}, i + 1, 1), '{EMPTY}'), {tries},
                array_min(transform({least}, h -> named_struct(
                    'at', xxhash64(i, {TRIES}, {number('h')}), 'digit', {digit('h')}))).digit
            )), '') end""",
    }
    kept = df.columns
    for column, sql in steps.items():
        df = df.withColumn(column, F.expr(sql))
    return df.select(*kept, name)


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two fingerprints, from 0 to 1.
    Two empty fingerprints are alike, an empty one is like no other."""
    same = f"""size(filter(sequence(1, {BINS}), i -> substring({a}, i, 1) = substring({b}, i, 1))) / {BINS}D"""
    chance = 0.5**BITS
    return F.expr(f"""case when {a} = {b} then 1D when {a} = '' or {b} = '' then 0D
        else greatest(0D, ({same} - {chance}D) / {1 - chance}D) end""")


def edited_and_next(docs: DataFrame) -> DataFrame:
    """(doc_id, copies, at, total, text, edited) of each distinct (doc_id, text).

    ``edited`` has the last half of the text replaced by the first code points of the next
    document in the order of descending doc_id (NULL last, then by a hash of the text); after
    the last comes the first. The order is worked out on ids alone, so texts move once to meet
    their place and half of them once more to meet the document before.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("none"),
        text.alias("text"),
    ).withColumn("th", F.xxhash64("text", "none"))
    ids = keyed.groupBy("k", "th").agg(
        F.max("none").alias("none"), F.count("*").alias("copies"), F.max(F.length("text")).alias("n")
    )
    placed = freeze(with_row_index(ids, [F.col("none"), F.col("k").desc(), F.col("th")], "at"))
    total = placed.count()
    after = placed.select(
        F.expr(f"(at + {max(total, 1)} - 1) % {max(total, 1)}").alias("at"),
        F.col("k").alias("next_k"), F.col("th").alias("next_th"),
    )
    pairs = placed.join(after, "at")
    texts = keyed.groupBy("k", "th").agg(F.first("text").alias("text"))
    heads = (
        texts.join(pairs.select("at", "n", F.col("next_k").alias("k"), F.col("next_th").alias("th"),
                                F.col("k").alias("own_k"), F.col("th").alias("own_th")), ["k", "th"])
        .select(F.col("own_k").alias("k"), F.col("own_th").alias("th"), F.expr("substring(text, 1, cast(n div 2 as int)) as head"))
    )
    own = texts.join(placed, ["k", "th"])
    return own.join(heads, ["k", "th"]).select(
        F.when(~F.col("none"), F.col("k")).alias("doc_id"), "copies", "at", F.lit(total).alias("total"),
        F.col("n").cast("bigint").alias("n_chars"), "text",
        F.expr("concat(substring(text, 1, cast(n - n div 2 as int)), head) as edited"),
    )


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    of every row.

    NULL text counts as empty and has the empty fingerprint. Rows equal in doc_id and text are
    one document in the order and give as many equal rows; one document is its own next. NULL
    doc_ids come last and stay NULL. Other columns are not read; an empty table gives no rows.
    """
    rows = edited_and_next(docs)
    rows = with_fingerprint(with_fingerprint(rows, "text", "fingerprint"), "edited", "edited_fingerprint")
    made = freeze(rows.select(
        "doc_id", "copies", "at", "total", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
    ))
    after = made.select(
        F.expr("(at + total - 1) % total").alias("at"), F.col("fingerprint").alias("next_fingerprint")
    )
    return (
        made.join(after, "at")
        .withColumn("near_next", likeness("fingerprint", "next_fingerprint"))
        .withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
        .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    )

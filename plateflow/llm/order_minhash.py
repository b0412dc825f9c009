"""Order MinHash fingerprints in DataFrame functions alone.

A text is a sequence of stretches; three on end are a k-mer. A stretch is a word of at most eight characters with the white
space before it; of longer runs without white space, such as texts in scripts that set none, it is eight characters from
each position on, so that a character more or less changes only the k-mers around it. Repeated
k-mers are numbered by occurrence, so that how often one occurs counts too. The hash of a numbered k-mer puts it into one
of 64 cells and ranks it there. Each cell keeps its two least k-mers *in the order of the text*, and the hash of that pair
is the cell's signature: it changes if text is replaced or moved, and so follows the edit distance.

Positions and hashes share 64-bit integers, which Spark sorts as primitive arrays; no row leaves its task for it.

Defined results: a null text is empty; a text without k-mers has the empty fingerprint, and two such texts have likeness
1; a text of fewer than three stretches has k-mers of what follows; repeated ids follow one another by text, null ids come
first; an empty table gives no rows; other columns are ignored, whatever their names. Positions count modulo 2^26.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words, cut into stretches of at most eight characters.
WORDS = r"(\S{1,8})"
#: Stretches by position: white space is taken with what follows it and is passed at once, so is a word of at most eight
#: characters; inside a longer run the match is empty and goes on by one character.
STEPPED = r"(?=(\s++\S{0,8}|\S{1,8}))(?:(?:(?<!\S)|(?=\s))\s*+\S{0,8}+(?!\S)|\s++|(?=\S{8}))"
#: Bits of an integer for the cell and for the position; the rest are the hash.
CELL_BITS, PLACE_BITS = 6, 26
KEPT = 2
#: Buckets of consecutive documents for each shuffle partition.
BUCKETS_EACH = 8

_PLACE = (1 << PLACE_BITS) - 1
_CELL_SHIFT = 64 - CELL_BITS


def _hash_part(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def _cell(x: Column) -> Column:
    return F.shiftrightunsigned(x, _CELL_SHIFT)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACE)).cast("int")


def _packed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(hashed, PLACE_BITS), PLACE_BITS).bitwiseOR(place.cast("long").bitwiseAND(F.lit(_PLACE)))


def with_signatures(docs: DataFrame, text: str, name: str, stretches: str = WORDS) -> DataFrame:
    """`docs` with the array `name`: the cell and signature of every filled cell as one integer, by cell.

    `stretches`: an expression whose first group is a stretch.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns]
    step = lambda df, **made: df.select(*keep, *[c.alias(n) for n, c in made.items()])
    at = lambda array, i: F.get(F.col(array), i)
    # Each step names what later ones use more than once, so that it is computed once.
    df = step(docs, _w=F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(stretches), F.lit(1)))
    df = step(df, _h=F.transform("_w", lambda w, i: F.xxhash64(w, at("_w", i + 1), at("_w", i + 2))))
    df = step(df, _h=F.col("_h"), _s=F.sort_array(F.transform("_h", _packed)))
    # Occurrence numbers: 1, 2, ... within each run of equal hashes.
    new = F.transform("_s", lambda x, i: F.when((i == 0) | (_hash_part(x) != _hash_part(at("_s", i - 1))), i))
    df = step(df, _h=F.col("_h"), _s=F.col("_s"), _b=F.filter(new, lambda i: i.isNotNull()))
    ends = F.concat(F.slice("_b", F.lit(2), F.greatest(F.size("_b"), F.lit(1))), F.array(F.size("_s")))
    number = F.flatten(F.zip_with("_b", ends, lambda b, e: F.when(b.isNotNull(), F.sequence(F.lit(1), e - b)).otherwise(F.array().cast("array<int>"))))
    ranked = F.zip_with("_s", number, lambda x, o: _packed(F.xxhash64(_hash_part(x), o), _place(x)))
    df = step(df, _h=F.col("_h"), _r=F.sort_array(ranked))
    least = F.filter("_r", lambda x, i: (i < KEPT) | (_cell(x) != _cell(at("_r", i - KEPT))))
    df = step(df, _h=F.col("_h"), _l=least)

    def signature(x: Column, i: Column) -> Column:
        after = at("_l", i + 1)
        two = F.coalesce(_cell(after) == _cell(x), F.lit(False))
        first, last = F.least(_place(x), F.when(two, _place(after))), F.greatest(_place(x), F.when(two, _place(after)))
        hashed = F.xxhash64(at("_h", first), F.when(two, at("_h", last)))
        value = F.shiftleft(_cell(x), PLACE_BITS).bitwiseOR(hashed.bitwiseAND(F.lit(_PLACE)))
        return F.when((i == 0) | (_cell(x) != _cell(at("_l", i - 1))), value)

    return df.select(*keep, F.filter(F.transform("_l", signature), lambda x: x.isNotNull()).alias(name))


def fingerprint(signatures: str) -> Column:
    """The signatures as text: eight hexadecimal digits for each filled cell."""
    return F.array_join(F.transform(signatures, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """The share of cells with equal signatures among those that either has."""
    cells = lambda name: F.transform(name, lambda x: F.shiftright(x, PLACE_BITS))
    either = F.size(F.array_union(cells(a), cells(b)))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either).cast("double")


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the value, by a list of first bounds and the lists behind them."""
    if not bounds:
        return F.lit(0)
    each = math.isqrt(len(bounds)) + 1
    lists = [bounds[i:i + each] for i in range(0, len(bounds), each)]
    literal = lambda numbers: F.array(*[F.lit(n).cast("long") for n in numbers])
    count = lambda numbers: F.size(F.filter(numbers, lambda b: b <= value))
    head = count(literal([part[0] for part in lists]))
    within = count(F.get(F.array(*[literal(part) for part in lists]), head - 1))
    return F.when(value.isNull(), -1).when(head == 0, 0).otherwise((head - 1) * each + within)


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """(id, text, signatures, next_text, next_signatures), the next document being that of the next larger id.

    Documents go to buckets of consecutive ids, whose bounds are quantiles of the ids, and each bucket gets a copy of the
    first document behind it. So neighbours meet without a global sort, and texts are shuffled once.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    wanted = BUCKETS_EACH * partitions
    shares = [i / wanted for i in range(1, wanted)]
    bounds = rows.agg(F.percentile_approx("id", F.array(*map(F.lit, shares)), 10 * wanted).alias("at")).first().at or []
    bucketed = rows.withColumn("bucket", _bucket(F.col("id"), sorted(set(bounds))))
    # One row per bucket: its least id, and through it the bucket before.
    firsts = sorted((row.bucket, row.least) for row in bucketed.groupBy("bucket").agg(F.min("id").alias("least")).collect())
    before = [(firsts[i - 1][0], bucket, least) for i, (bucket, least) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(before, "into int, bucket int, least long"))
    head = bucketed.join(heads, (bucketed.bucket == heads.bucket) & bucketed.id.eqNullSafe(heads.least)).groupBy("into").agg(F.min("text").alias("text"), F.first("id").alias("id"))
    both = bucketed.select("bucket", "id", "text", F.lit(False).alias("guard")).unionByName(head.select(F.col("into").alias("bucket"), "id", "text", F.lit(True).alias("guard")))
    signed = with_signatures(both.repartition(partitions, "bucket"), "text", "signatures", STEPPED)
    along = Window.partitionBy("bucket").orderBy("guard", F.col("id").asc_nulls_first(), "text")
    led = signed.select("id", "text", "signatures", "guard", F.lead("text").over(along).alias("next_text"), F.lead("signatures").over(along).alias("next_signatures"))
    return led.where(~F.col("guard")).drop("guard")


def edited_likeness(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of documents and of their edited texts, and how like they are.

    The edited text has the last quarter of its code points replaced by the first as many of the next document.
    """
    size = F.char_length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), size - quarter), F.col("next_text").substr(F.lit(1), quarter))
    df = with_next(docs, id, text).select("id", size.cast("long").alias("n_chars"), "signatures", "next_signatures", edited.alias("edited"))
    df = df.select("id", "n_chars", "signatures", "next_signatures", "edited", F.sha2("edited", 256).alias("edited_sha256"))
    df = with_signatures(df, "edited", "edited_signatures", STEPPED)
    return df.select(
        F.col("id").alias(id), "n_chars", "edited_sha256",
        fingerprint("signatures").alias("fingerprint"),
        fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )

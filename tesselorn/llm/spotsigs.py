"""Document fingerprints by SpotSigs, in DataFrame functions alone.

A signature is a chain of content words that follows an anchor, a common word;
common words within the chain are passed over. Such chains sit in running text
and not in menus or markup around it. A document's fingerprint is the set of
its signatures' 32-bit hashes. Documents are compared by the Jaccard
coefficient, which the set lengths alone bound: pairs of too different lengths
are not compared, so documents are partitioned by length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselorn.llm.common import written

# Very common words of English, German, French and Spanish.
COMMON = (
    "the of and a to is in that it for was on with as be by at this "
    "der die das und ist nicht zu ein eine mit den von "
    "le la les des et est un une dans que pour "
    "el los las y en se por con del"
).split()
CHAIN = 3
THRESHOLD = 0.8
#: Rows of a range of ids, about, in which the next document is looked for; and
#: the most ranges there are: beyond, a range's sort spills more.
RANGE_ROWS, MOST_RANGES = 4_000, 1 << 16
#: Marks a content word that follows an anchor; no word contains it.
AFTER = "\x01"


def signatures(text: Column, chain: int = CHAIN, common: list[str] = COMMON) -> Column:
    """Sorted distinct signature hashes of a text (array<int>). A text in which
    no anchor is followed by a whole chain has one signature, all its words; a
    text without words has one if it is not empty, and else none. Null: as empty."""
    whole = F.coalesce(text, F.lit(""))

    def chained(content: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(content) - (chain - 1)), lambda i: F.startswith(F.get(content, i - 1), F.lit(AFTER)))
        words = lambda i: F.concat(F.lit(" "), F.translate(F.array_join(F.slice(content, i, chain), " "), AFTER, ""))
        return F.when(F.size(content) >= chain, F.transform(starts, lambda i: F.xxhash64(words(i)).bitwiseAND(F.lit(0xFFFFFFFF)))).otherwise(F.array().cast("array<bigint>"))

    def found(body: Column) -> Column:
        # a chain starts at a content word whose word before is an anchor: marked in one pass
        marked = lambda words: F.transform(words, lambda w, i: F.when(w.isin(common), "").when((i > 0) & F.get(words, i - 1).isin(common), F.concat(F.lit(AFTER), w)).otherwise(w))
        content = _bound(F.split(body, " "), lambda words: F.filter(marked(words), lambda w: w != ""))
        alone = F.when(whole == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.when(body == "", whole).otherwise(F.concat(F.lit(" "), body, F.lit(" ")))).bitwiseAND(F.lit(0xFFFFFFFF))))
        return _bound(_bound(content, chained), lambda h: F.when(F.size(h) > 0, h).otherwise(alone))

    body = F.trim(F.regexp_replace(F.lower(whole), r"[^\p{L}\p{N}]+", " "))
    return F.array_sort(F.array_distinct(_bound(body, found)))


def _bound(value: Column, then) -> Column:
    """``then(value)``, with the value computed once: a column named twice would
    be computed twice, and in a lambda once an element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def as_text(sigs: Column) -> Column:
    """A fingerprint as 8 hexadecimal digits a signature, ascending."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Likeness of two fingerprints, 0 to 1. Pairs whose lengths bound it below
    ``least`` are not compared and give 0. Two empty ones are alike: 1."""
    n, m = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    exact = F.when((n == 0) & (m == 0), 1.0).otherwise(common / (n + m - common).cast("double"))
    return F.when(a == b, 1.0).when(F.least(n, m) < least * F.greatest(n, m), 0.0).otherwise(exact)


def _place(bounds: list[tuple[int, int]], *key: Column) -> Column:
    """How many of the sorted pairs are less than the key, by halving."""
    of = [F.expr(f"cast(split('{','.join(str(b[i]) for b in bounds)}', ',') as array<bigint>)") for i in (0, 1)]
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]

    def less(nth: Column) -> Column:
        a, b = F.get(of[0], nth), F.get(of[1], nth)
        return F.coalesce((a < key[0]) | ((a == key[0]) & (b < key[1])), F.lit(False))

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda n, s: F.when(less(n + s - 1), n + s).otherwise(n))


def with_next(docs: DataFrame, id_col: str, text_col: str, columns: list[str]) -> DataFrame:
    """``columns`` of each row and, as next_..., of the row after it in
    descending id (null last; ties by the text's hash), after the last of the
    first. Rows are dealt to ranges of ids and hashes, so an id that repeats, or
    null, fills no task alone; the greatest of a range also goes, as a mark, to
    the range above: one exchange of the rows, no single task."""
    spark = docs.sparkSession
    key = [F.coalesce(F.col(id_col), F.lit(-(1 << 63))).alias("_id"), F.xxhash64(text_col).alias("_hash")]
    keys = docs.select(*key)
    ranges = max(1, min(-(-keys.count() // RANGE_ROWS), MOST_RANGES))
    # the greatest key of each range: a row a range comes to the driver
    dealt = keys.repartitionByRange(ranges, "_id", "_hash")
    tops = sorted((r["top"]["_id"], r["top"]["_hash"]) for r in dealt.groupBy(F.spark_partition_id()).agg(F.max(F.struct("_id", "_hash")).alias("top")).collect())
    if not tops:
        return docs.select(*columns, *[F.col(c).alias(f"next_{c}") for c in columns])
    own = docs.select(*columns, *key)
    part, last = _place(tops, F.col("_id"), F.col("_hash")), len(tops) - 1
    tops_of = [F.expr(f"cast(split('{','.join(str(t[i]) for t in tops)}', ',') as array<bigint>)") for i in (0, 1)]
    own = own.withColumn("_part", part)
    is_top = (F.get(tops_of[0], F.col("_part")) == F.col("_id")) & (F.get(tops_of[1], F.col("_part")) == F.col("_hash"))
    at = lambda p, mark: F.struct(p.alias("p"), F.lit(mark).alias("mark"))
    above = F.when(F.col("_part") == last, 0).otherwise(F.col("_part") + 1)
    copies = F.explode(F.when(is_top, F.array(at(F.col("_part"), 1), at(above, 0))).otherwise(F.array(at(F.col("_part"), 1))))
    order = Window.partitionBy("_to.p").orderBy("_to.mark", "_id", "_hash")
    out = own.withColumn("_to", copies).select(*columns, "_to", *[F.lag(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("_to.mark = 1").drop("_to")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each whole text, of the next document's and of an edited
    text: the last third of the code points replaced by as many of the start of
    the next document (descending id; after the last the first).

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) for each row; null texts count as empty, null ids
    come last, rows that repeat an id are ordered by their text's hash. A lone
    document is its own next. An empty table gives an empty result.
    """
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    base = base.withColumn("sigs", signatures(F.col("text")))
    pairs = with_next(base, "doc_id", "text", ["doc_id", "text", "sigs"])
    n = F.length("text").cast("long")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - third), F.substring("next_text", F.lit(1), third))
    pairs = pairs.select("doc_id", n.alias("n_chars"), "sigs", "next_sigs", edited.alias("edited"))
    pairs = pairs.select("*", signatures(F.col("edited")).alias("edited_sigs"))
    return pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sigs")).alias("fingerprint"), as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members (doc_id, class_id) puts documents of equal
    fingerprint in the class of their smallest id; pairs (a, b, likeness) are
    all class representatives with a < b and a likeness of at least
    ``threshold``.

    Sets are partitioned by length, so that partners lie in one partition or the
    next. A set looks for partners by its rarest signatures only: so many that
    two sets without any of them in common stay below the threshold. Null ids
    are left out; null texts count as empty. No cap on partners.
    """
    base = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), signatures(F.col(f"`{text_col}`")).alias("sigs"))
    base = written(base)
    sets = written(base.groupBy("sigs").agg(F.min("doc_id").alias("class_id")))
    members = base.join(sets, "sigs").select("doc_id", "class_id")
    entries = sets.where(F.size("sigs") > 0).select("class_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    rarity = entries.groupBy("sig").agg(F.count("*").alias("df"))
    nth = F.row_number().over(Window.partitionBy("class_id").orderBy("df", "sig"))
    prefix = entries.join(rarity, "sig").withColumn("nth", nth).where(F.col("nth") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1)
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(threshold)) + 1e-9).cast("int")
    prefix = prefix.withColumn("band", band).select("class_id", "n", "sig", "band")
    small = prefix.select(F.col("class_id").alias("x"), F.col("n").alias("xn"), "sig", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    large = prefix.select(F.col("class_id").alias("y"), F.col("n").alias("yn"), "sig", "band")
    fitting = ((F.col("xn") < F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("x") < F.col("y")))) & (F.col("xn") >= F.lit(threshold) * F.col("yn") - 1e-9)
    candidates = small.join(large, ["sig", "band"]).where(fitting).select("x", "y").distinct()
    left, right = sets.select(F.col("class_id").alias("x"), F.col("sigs").alias("xs")), sets.select(F.col("class_id").alias("y"), F.col("sigs").alias("ys"))
    scored = candidates.join(left, "x").join(right, "y").withColumn("likeness", jaccard(F.col("xs"), F.col("ys"), threshold)).where(F.col("likeness") >= threshold)
    return members, scored.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness")

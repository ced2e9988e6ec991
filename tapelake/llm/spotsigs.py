"""SpotSigs document fingerprints, in DataFrame functions only.

Wherever a common word (an anchor) stands, the next content words form a signature.
The set of a text's signatures is its fingerprint; boilerplate without running prose
has few anchors and weighs little. Sets are compared by Jaccard similarity, which
cannot exceed the ratio of the smaller to the larger set: sets are partitioned by
length so that only neighbouring partitions can match, and within them signatures
are met from the rarest on, up to the number that a match must share one of.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs
from tapelake.llm.components import components
from tapelake.workspace import materialize

CHAIN_WORDS = 2
LIKE = 0.8
ROWS_PER_RANGE = 2048
MOST_RANGES = 100_000

# Common words of the corpus languages.
ANCHORS = (
    "the of and to in is that it for was on are as with by be at or from this an "
    "de la le les des et un une du en que qui dans pour par sur est au "
    "der die und den von zu das mit sich ein eine nicht ist im dem auf "
    "el los las y una por para se del al con su"
)
MARK = "\n"  # stands for an anchor; words hold no line ends
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def signatures(text: Column, chain_words: int = CHAIN_WORDS) -> Column:
    """Sorted distinct signatures of a text.

    The text is cut at runs of anchors; a chain starts at each piece behind one and
    runs on, over later anchors, until it has its words. A text without any chain has
    one signature of all its words, so an empty text has one too.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")
    common = list(dict.fromkeys(ANCHORS.split()))
    marked = F.transform(words, lambda word: F.when(word.isin(common), MARK).otherwise(word))
    cut = F.transform(F.split(F.array_join(marked, " "), MARK), lambda piece: F.trim(piece))

    def without_blanks(pieces: Column) -> Column:
        behind = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.concat(F.slice(pieces, 1, 1), F.filter(behind, lambda piece: piece != ""))

    def chains(pieces: Column) -> Column:
        numbered = F.transform(
            pieces,
            lambda piece, i: F.when(
                i > 0,
                F.xxhash64(
                    F.substring_index(F.array_join(F.slice(pieces, i + 1, chain_words), " "), " ", chain_words)
                ),
            ),
        )
        return F.array_sort(F.array_distinct(F.array_compact(numbered)))

    # Each step is bound to a name by a transform over one element, and so worked out once.
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    found = F.transform(F.transform(F.array(cut), without_blanks), chains)
    return F.transform(found, lambda own: F.when(F.size(own) > 0, own).otherwise(whole))[0]


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without a comparison where their sizes rule out ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    whole = common / (F.size(a) + F.size(b) - common)
    return F.when(small < large * least, 0.0).when(a == b, 1.0).otherwise(whole)


def fingerprint(found: Column) -> Column:
    """The set as 32 hex digits; equal sets, and so equal texts, have equal fingerprints."""
    return F.md5(F.array_join(F.transform(found, F.hex), ","))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """Rows (doc_id, text, ghost) and a window in which each row stands before the next by falling doc_id.

    Ids are cut into ranges of about equal counts. The first row of each range also
    stands, as a ghost, behind the last row of the range above; the very first row
    stands behind the very last. Missing ids are the smallest, equal ids follow their
    texts. Only bounds and first ids of the ranges reach the driver.
    """
    rows = inputs(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    keys = rows.select(key.alias("key"))
    n = keys.count()
    ranges = max(1, math.ceil(n / max(ROWS_PER_RANGE, n / MOST_RANGES)))
    cuts = [i / ranges for i in range(1, ranges)]
    found = keys.agg(F.percentile_approx("key", cuts, max(10_000, 20 * ranges))).first()[0] if cuts and n else []
    bounds = sorted(set(found or []))
    part = range_of(key, bounds)
    first = {r[0]: r[1] for r in keys.groupBy(range_of(F.col("key"), bounds).alias("part")).agg(F.max("key")).collect()}
    filled = sorted(first)
    above = dict(zip(filled, [*filled[1:], *filled[:1]], strict=True))
    order = range(len(bounds) + 1)
    heads, targets = (F.array(*(F.lit(x.get(p)).cast("long") for p in order)) for x in (first, above))
    if len(bounds) > 50:
        heads, targets = (
            F.from_json(F.lit(str([x.get(p, None) for p in order]).replace("None", "null")), "array<bigint>")
            for x in (first, above)
        )
    placed = rows.withColumn("part", part).withColumn("key", key)
    own = F.struct(F.col("part"), F.lit(False).alias("ghost"))
    copy = F.struct(F.get(targets, F.col("part")).alias("part"), F.lit(True).alias("ghost"))
    both = F.when(F.get(heads, F.col("part")) == F.col("key"), F.array(own, copy)).otherwise(F.array(own))
    placed = placed.withColumn("place", F.explode(both)).select("doc_id", "text", "key", "place.*")
    return placed, Window.partitionBy("part").orderBy("ghost", F.desc("key"), "text")


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the key, found in two steps of about sqrt(len(bounds)) each."""
    if not bounds:
        return F.lit(0).cast("long")
    step = max(1, math.isqrt(len(bounds)))
    coarse = bounds[::step]
    fine = F.from_json(F.lit(str(bounds)), "array<bigint>")
    upper = F.from_json(F.lit(str(coarse)), "array<bigint>")
    at = F.size(F.filter(upper, lambda b: b <= key))
    block = F.slice(fine, F.greatest(at - 1, F.lit(0)) * step + 1, step)
    return (F.greatest(at - 1, F.lit(0)) * step + F.size(F.filter(block, lambda b: b <= key))).cast("long")


def edited_likeness(
    docs: DataFrame, chain_words: int = CHAIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness, for every row.

    The edited text has its last floor(n/2) code points replaced by the first as many
    of the next document by falling doc_id. Texts are dealt out once, by id range.
    Null texts count as empty; repeated rows follow each other; other columns are ignored.
    """
    rows, order = with_next(docs, id_col, text_col)
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars") - half), F.left(F.coalesce("next", F.lit("")), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "doc_id",
        "key",
        "part",
        "ghost",
        "text",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        signatures(F.col("text"), chain_words).alias("own"),
        signatures(F.col("edited"), chain_words).alias("changed"),
    )
    rows = rows.withColumn("following", F.lead("own").over(order)).where(~F.col("ghost"))
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.col("own").alias("signatures"),
    )


def length_partition(size: Column, least: float) -> Column:
    """Partition of a set size: sizes two partitions apart cannot have likeness ``least``."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(least)) + F.lit(1e-9)).cast("int")


def similar_sets(sets: DataFrame, least: float = LIKE) -> DataFrame:
    """Pairs (a, b, likeness), a < b, of the distinct sets (set_id, signatures) that are alike enough.

    A set is listed under its rarest signatures, as many as a match must share one of,
    and meets sets of its own and the next length partition there.
    """
    sets = sets.where(F.size("signatures") > 0)
    listed = sets.select("set_id", F.size("signatures").alias("n"), F.explode("signatures").alias("signature"))
    uses = listed.groupBy("signature").agg(F.count(F.lit(1)).alias("uses"))
    ranked = listed.join(uses, "signature").groupBy("set_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("uses", "signature"))).alias("ranked")
    )
    needed = (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int")
    part = length_partition(F.col("n"), least)
    prefix = ranked.select(
        "set_id", "n", part.alias("part"), F.explode(F.slice("ranked", 1, needed)).alias("entry")
    ).select("set_id", "n", "part", "entry.signature")
    left = prefix.select(
        F.col("set_id").alias("a"), F.col("n").alias("n_a"), "signature",
        F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"),
    )
    right = prefix.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), "signature", "part")
    met = (
        left.join(right, ["signature", "part"])
        .where((F.col("a") != F.col("b")) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least - 1e-9))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    named = sets.select("set_id", "signatures")
    pairs = met.join(named.toDF("a", "of_a"), "a").join(named.toDF("b", "of_b"), "b")
    alike = likeness(F.col("of_a"), F.col("of_b"), least)
    return pairs.select("a", "b", alike.alias("likeness")).where(F.col("likeness") >= least - 1e-12)


def near_duplicates(
    docs: DataFrame, least: float = LIKE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked by likeness; copies count as one set."""
    rows = inputs(docs, doc_id=id_col, text=text_col)
    rows = rows.withColumn("signatures", signatures(F.col("text"))).withColumn("fingerprint", fingerprint(F.col("signatures")))
    rows = materialize(rows.select("doc_id", "fingerprint", "signatures"), "signatures")
    sets = rows.groupBy("fingerprint").agg(
        F.min("doc_id").alias("least"), F.first("signatures").alias("signatures")
    )
    sets = materialize(sets.withColumn("set_id", F.monotonically_increasing_id()), "sets")
    found = components(similar_sets(sets.select("set_id", "signatures"), least).select("a", "b"))
    rooted = sets.join(found, sets["set_id"] == found["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "set_id").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(named, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")

"""Fingerprints by spot signatures, in Spark SQL only.

Where a common word (an anchor) stands before a word of content, a spot begins: the anchor and the next ``2`` words of
content, with anchors between them passed over; of anchors in a row the last one counts. The fingerprint
is the set of the hashed spots. Boilerplate has few anchors and so hardly any spots, running text has many.

Sets are compared by their Jaccard index. ``near_pairs`` deals sets out by length (sets whose lengths differ too much can't be
alike), lets them meet only at their rarest spots, and leaves out pairs whose lengths rule them out
before it compares.

Defined cases: a null text is empty and has the empty set; two empty sets are alike (1), an empty and another
are not (0); a text without any spot takes all neighbouring words for spots, or its only word; rows without
doc_id stand first in the order of documents; rows that share a doc_id follow each other by text; very long texts are read whole; an
empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import stage

# The anchors, common words of four languages.
ANCHORS = (
    "the of and to in is that for it as was with be by on not this are from at or an a he they but have had which "
    "der die das und ist nicht ein eine mit von zu den dem des im auf für sich auch als "
    "le la les de du et un une est que qui dans pour pas sur par au ce il ne "
    "el los las y del al con por se lo su es una no más como"
).split()
NOT_WORDS = r"[^\p{L}\p{N}]+"


def spots(text: Column) -> Column:
    """The hashes of the words of a text, in order."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_WORDS, " "))
    return F.when(F.length(plain) == 0, F.array().cast("array<long>")).otherwise(F.transform(F.split(plain, " "), lambda w: F.xxhash64(w)))


def with_spots(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the spots of a column; each step is a column of its own, so that no array is worked out twice."""
    hashed, content = f"_{out}_words", f"_{out}_content"
    anchors = ", ".join(f"{h}L" for h in sorted(_hashes(df)))
    df = df.withColumn(hashed, spots(F.col(text)))
    lead = f"zip_with({hashed}, concat(array(0L), {hashed}), (x, p) -> if(x IS NULL OR x IN ({anchors}), NULL, struct(x AS x, if(p IN ({anchors}), p, NULL) AS lead)))"
    df = df.withColumn(content, F.expr(f"filter({lead}, c -> c IS NOT NULL)"))
    chains = f"zip_with({content}, slice({content}, 2, greatest(size({content}) - 1, 0)), (c, d) -> if(c.lead IS NULL OR d IS NULL, NULL, hash(c.lead, c.x, d.x)))"
    df = df.withColumn(out, F.expr(f"array_sort(array_distinct(filter({chains}, s -> s IS NOT NULL)))"))
    every = f"zip_with({hashed}, slice({hashed}, 2, greatest(size({hashed}) - 1, 0)), (x, y) -> if(y IS NULL, NULL, hash(x, y)))"
    every = f"CASE WHEN size({hashed}) = 1 THEN transform({hashed}, x -> hash(x)) ELSE array_sort(array_distinct(filter({every}, s -> s IS NOT NULL))) END"
    df = df.withColumn(out, F.expr(f"CASE WHEN size({out}) > 0 OR size({hashed}) = 0 THEN {out} ELSE {every} END"))
    return df.drop(hashed, content)


def _hashes(df: DataFrame) -> list[int]:
    """The hashes of the anchors, as Spark works them out."""
    one = df.sparkSession.createDataFrame([(ANCHORS,)], "a array<string>")
    return one.select(F.transform("a", lambda w: F.xxhash64(w)).alias("h")).first().h


def jaccard(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard index of two columns of sets; 0 without a comparison where their lengths alone keep it under ``least``."""
    common = F.size(F.array_intersect(a, b))
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    alike = common / (small + large - common)
    return F.when(large == 0, 1.0).when(small < least * large, 0.0).otherwise(alike).cast("double")


def near_pairs(sets: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``a, b, likeness`` of pairs of distinct sets, named by their smallest doc_id, and ``doc_id, named`` of all documents.

    A set and its partner of at least that likeness share one of their rarest spots: with spots ordered by how many
    sets have them, one of the first ``n - ceil(least * n) + 1`` of either. These meet by a join on the spot and the
    length class; a set is also copied to the class below, as lengths of partners differ by the factor ``least`` at most.
    """
    own = sets.where(F.col("doc_id").isNotNull() & (F.size("spots") > 0))
    named = own.groupBy("spots").agg(F.min("doc_id").alias("named"))
    members = own.join(named, "spots").select("doc_id", "named")
    sizes = named.withColumn("n", F.size("spots")).withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least)) + 1e-9))
    sizes = stage(sizes, "sets")
    tokens = sizes.select("named", "n", "class", F.explode("spots").alias("spot"))
    common = tokens.groupBy("spot").agg(F.count(F.lit(1)).alias("held"))
    ranked = tokens.join(common, "spot").groupBy("named", "n", "class").agg(F.array_sort(F.collect_list(F.struct("held", "spot"))).alias("by_rarity"))
    prefix = ranked.select("named", "n", "class", F.explode(F.expr(f"slice(by_rarity, 1, n - cast(ceil({least} * n - 1e-9) AS int) + 1)")).alias("r")).select("named", "n", "class", F.col("r.spot").alias("spot"))
    left = prefix.select(F.col("named").alias("a"), F.col("n").alias("n_a"), "class", "spot")
    right = prefix.select(F.col("named").alias("b"), F.col("n").alias("n_b"), F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("class"), F.col("class").alias("class_b"), "spot")
    # The longer set looks into its own class and the one below.
    pairs = left.join(right, ["class", "spot"]).where("n_a <= n_b AND a <> b AND n_a >= n_b * " + repr(least - 1e-9) + " AND (class_b > class OR class_b = class)")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = sizes.select(F.col("named").alias("a"), F.col("spots").alias("spots_a"))
    second = sizes.select(F.col("named").alias("b"), F.col("spots").alias("spots_b"))
    alike = pairs.join(first, "a").join(second, "b").select("a", "b", jaccard("spots_a", "spots_b", least).alias("likeness"))
    return alike.where(F.col("likeness") >= least), members


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``next_<column>`` of the following document, ascending by doc_id; after the last comes the first.

    Documents are dealt out by ranges of doc_id. The first of each range is copied to the end of the range
    before, and the very first to the end of the last, so that no row is looked for elsewhere.
    """
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    shares = [i / ranges for i in range(1, ranges)]
    low, cuts = df.select(key.alias("k")).agg(F.min("k"), F.percentile_approx("k", shares, 10_000)).first()
    if low is None:
        return df.withColumns({f"next_{c}": F.col(c) for c in columns})
    cuts = sorted(set(cuts) - {low})
    if cuts:
        known = F.array(*map(F.lit, cuts))
        place = F.size(F.filter(known, lambda c: c <= F.col("_key")))
        opens = F.array_contains(known, F.col("_key"))
    else:
        place, opens = F.lit(0), F.lit(False)
    placed = df.withColumn("_key", key).withColumn("_range", place)
    spot = lambda at, ghost, last: F.struct(at.alias("range"), F.lit(ghost).alias("ghost"), F.lit(last).alias("last"))
    spots_ = F.when(F.col("_key") == low, F.array(spot(F.col("_range"), False, False), spot(F.lit(len(cuts)), True, True)))
    spots_ = spots_.when(opens, F.array(spot(F.col("_range"), False, False), spot(F.col("_range") - 1, True, False)))
    placed = placed.withColumn("_at", F.explode(spots_.otherwise(F.array(spot(F.col("_range"), False, False)))))
    by = Window.partitionBy("_at.range").orderBy("_at.last", "_key", "text")
    out = placed.withColumns({f"next_{c}": F.lead(c).over(by) for c in columns})
    return out.where("NOT _at.ghost").drop("_key", "_range", "_at")


def op8_spots(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = with_next(with_spots(docs, "text", "spots"), ["text", "spots"])
    df = df.withColumn("n_chars", F.char_length("text")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.expr("substring(text, 1, n_chars - half)"), F.expr("substring(next_text, 1, half)"))
    df = df.withColumn("edited", edited).drop("text", "next_text")
    df = with_spots(df, "edited", "edited_spots")
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return df.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        text("spots").alias("fingerprint"),
        text("edited_spots").alias("edited_fingerprint"),
        jaccard("spots", "edited_spots").alias("near_edited"),
        jaccard("spots", "next_spots").alias("near_next"),
    )

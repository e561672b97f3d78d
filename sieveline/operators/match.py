"""Joins: matching parties by equal keys, by similar names, within a band of time and within intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import text


#: Members of a key beyond which it is cut into slices.
HOT = 2000


def pairs_within(members: DataFrame, keys: Sequence[str], member: str, carry: Sequence[str] = (), hot: int = HOT) -> DataFrame:
    """(keys..., a, b, carry_a..., carry_b...), a < b: all pairs of members with equal keys; members are distinct a key.

    A key of more than ``hot`` members is cut into slices of about that size, and every pair of slices meets under a key of its
    own, so that no task holds all pairs of a key; other keys are joined as they are.
    """
    sizes = members.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > hot)
    m = members.join(sizes, list(keys), "left").withColumn("__k", F.coalesce(F.ceil(F.col("__n") / hot), F.lit(1)).cast("int"))
    m = m.withColumn("__s", F.pmod(F.xxhash64(member), F.col("__k")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("__k") - 1))
    own = lambda side: [F.col(c).alias(f"{c}_{side}") for c in carry]
    a = m.select(*keys, F.col(member).alias("a"), *own("a"), F.col("__s").alias("__sa"), every.alias("__sb"))
    b = m.select(*keys, F.col(member).alias("b"), *own("b"), F.col("__s").alias("__sb"), every.alias("__sa"))
    return a.join(b, [*keys, "__sa", "__sb"]).where(F.col("a") < F.col("b")).drop("__sa", "__sb")


def cross_match(values: DataFrame, party: str, keys: Sequence[str], evidence: str) -> DataFrame:
    """Parties a < b that share a key, with the number of shared keys and their evidence.

    values has one row a hit. Hits are summed to one row a (party, key) first, so the self-join meets each shared key once.
    """
    one = values.groupBy(*keys, party).agg(F.array_sort(F.collect_set(evidence)).alias("ids"))
    pairs = pairs_within(one, keys, party, ["ids"])
    return pairs.select(*keys, F.col("a").alias("party_a"), F.col("b").alias("party_b"), F.array_sort(F.array_distinct(F.concat("ids_a", "ids_b"))).alias("evidence_ids"))


def similar_names(names: DataFrame, group: str, key: str, least: float = 0.75) -> DataFrame:
    """Pairs of different search keys of one group with a similarity of at least ``least``.

    Candidates come from an exact filter. A pair needs as many common characters (counted with repetition) as the similarity asks
    for, or the shorter key must be contained and have 0.4 of the longer one's length; so the common characters are at least
    0.4 of either key. With the characters of each key in the order of their rarity in the group, both keys then share one
    among all but the last 0.4 n - 1 of them: only these are joined, and the commonest characters hardly ever are.
    """
    k = names.select(group, key).where(F.col(key) != "").distinct().withColumn("n", F.length(key))
    chars = k.select(group, key, "n", F.explode(F.filter(F.split(key, ""), lambda x: x != "")).alias("c")).groupBy(group, key, "n", "c").agg(F.count("*").alias("m"))
    tokens = chars.select(group, key, "n", F.explode(F.transform(F.sequence(F.lit(1), F.col("m").cast("int")), lambda i: F.concat("c", i.cast("string")))).alias("t"))
    rare = tokens.groupBy(group, "t").agg(F.count("*").alias("f"))
    lists = tokens.join(rare, [group, "t"]).groupBy(group, key, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "t"))), lambda x: x["t"]).alias("ts"))
    share = min(0.4, least)
    head = lists.select(group, key, F.explode(F.slice("ts", 1, F.col("n") - F.ceil(F.col("n") * share).cast("int") + 1)).alias("t"))
    met = pairs_within(head, [group, "t"], key).select(group, "a", "b").distinct()
    side = lambda s: lists.select(group, F.col(key).alias(s), F.col("n").alias(f"n{s}"), F.col("ts").alias(f"t{s}"))
    shared = met.join(side("a"), [group, "a"]).join(side("b"), [group, "b"]).withColumn("common", F.size(F.array_intersect("ta", "tb")))
    enough = (2 * F.col("common") >= least * (F.col("na") + F.col("nb"))) | ((F.col("common") == F.least("na", "nb")) & (F.least("na", "nb") / F.greatest("na", "nb") >= 0.4))
    scored = shared.where(enough).withColumn("similarity", F.round(text.name_similarity(F.col("a"), F.col("b")), 3))
    return scored.where(F.col("similarity") >= least).select(group, F.col("a").alias("name_a"), F.col("b").alias("name_b"), "similarity")


def band_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_us: str, right_us: str, width_us: int) -> DataFrame:
    """Pairs whose times lie at most ``width_us`` microseconds apart, ends included.

    Both sides get a bucket of that width; the left side looks into its own and the two neighbouring buckets, so the join is an
    equality join for Spark and each pair is met exactly once.
    """
    bucket = lambda c: F.floor(F.col(c) / F.lit(width_us)).cast("bigint")
    a = left.withColumn("__b", F.explode(F.array(bucket(left_us) - 1, bucket(left_us), bucket(left_us) + 1)))
    b = right.withColumn("__b", bucket(right_us))
    return a.join(b, [*on, "__b"]).where(F.abs(F.col(left_us) - F.col(right_us)) <= width_us).drop("__b")


def effective_at(start: Column, end: Column, at: Column) -> Column:
    """Whether an interval with both ends included holds a day; a missing end is open, a missing day is taken as held."""
    return F.coalesce(F.coalesce(start <= at, F.lit(True)) & F.coalesce(at <= end, F.lit(True)), F.lit(True)) | at.isNull()


def attribution(records: DataFrame, subjects: DataFrame, code: str, name: str, subject_id: str) -> DataFrame:
    """Subject of each record by code first, then by name: confirmed, candidate or unconfirmed.

    Where several subjects share a key the smallest id counts; a record whose code finds nobody still falls to its name.
    """
    by_code = subjects.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("__c")).agg(F.min(subject_id).alias("by_code"))
    by_name = subjects.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("__n")).agg(F.min(subject_id).alias("by_name"))
    j = records.join(by_code, F.col(code) == F.col("__c"), "left").join(by_name, F.col(name) == F.col("__n"), "left")
    status = F.when(F.col("by_code").isNotNull(), "confirmed").when(F.col("by_name").isNotNull(), "candidate").otherwise("unconfirmed")
    return j.withColumn("subject_id", F.coalesce("by_code", "by_name")).withColumn("attribution", status).drop("__c", "__n", "by_code", "by_name")


def coverage(subjects: DataFrame, sources: DataFrame, queries: DataFrame, subject: str, source: str, status: str, missing: str = "not_queried", slices: int = 16) -> DataFrame:
    """A row for each subject and source: the status of its query, or ``missing``.

    Sources are dealt out to slices and every subject meets every slice, an equality join of any size on either side.
    """
    many = subjects.select(subject).distinct().select(subject, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("__s"))
    dealt = sources.select(source).distinct().withColumn("__s", F.pmod(F.xxhash64(source), F.lit(slices)).cast("int"))
    dense = many.join(dealt, "__s").drop("__s")
    return dense.join(queries.select(subject, source, status), [subject, source], "left").withColumn(status, F.coalesce(status, F.lit(missing)))


def common_owner(edges: DataFrame, owner: str, party: str) -> DataFrame:
    """Parties a < b below one direct owner, one row a pair with the number of common owners."""
    one = edges.select(owner, party).where(F.col(owner).isNotNull()).distinct()
    pairs = pairs_within(one, [owner], party)
    return pairs.groupBy(F.col("a").alias("party_a"), F.col("b").alias("party_b")).agg(F.count("*").alias("n_owners"), F.min(owner).alias("first_owner"))

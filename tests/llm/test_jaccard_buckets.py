"""The step of the Jaccard join that compares the members of a bucket across components."""

from frameml.llm import jaccard_join
from frameml.llm.jaccard_join import _pairs_across

DOCS = "doc_id long, text string"
STARS = "sig long, a long, b long"
PARTS = "node long, component long"
WORDS = [f"w{i}" for i in range(120)]
OTHER = [f"v{i}" for i in range(120)]


def case(spark):
    """1, 2, 3 and 7 are near; 4 is another text, 5 and 6 are of one component; 8 and 9 meet in a bucket of two."""
    texts = {1: WORDS, 2: WORDS + ["x"], 3: WORDS + ["y"], 4: OTHER, 5: WORDS + ["z"], 6: WORDS + ["u"], 7: WORDS + ["t"],
             8: WORDS + ["s"], 9: WORDS + ["r"]}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], DOCS)
    hubs = {10: (1, [2, 3, 4]), 11: (1, [2, 3, 7]), 12: (2, [3, 5, 6]), 13: (5, [6]), 14: (8, [9])}
    stars = spark.createDataFrame([(s, hub, m) for s, (hub, members) in hubs.items() for m in members], STARS)
    return stars, spark.createDataFrame([(5, 5), (6, 5)], PARTS), docs


def test_every_pair_of_a_bucket_is_found(spark):
    near = sorted([(1, 2), (1, 3), (1, 7), (2, 3), (2, 7), (3, 7), (2, 5), (2, 6), (3, 5), (3, 6)])
    assert sorted(map(tuple, _pairs_across(*case(spark), 4, 85).collect())) == near


def test_tiles_of_two_members(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 2)
    near = sorted([(1, 2), (1, 3), (1, 7), (2, 3), (2, 7), (3, 7), (2, 5), (2, 6), (3, 5), (3, 6)])
    assert sorted(map(tuple, _pairs_across(*case(spark), 4, 85).collect())) == near


def test_copies_for_the_buckets_are_not_joined_or_held(spark, monkeypatch):
    """A row of an id grows to one for each of its buckets, with sketch and numbers.  That comes after all joins, and the
    number of tasks that do it follows the rows."""
    monkeypatch.setattr(jaccard_join, "TASK_LINES", 1, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The plan's last operator comes first.
        plan = _pairs_across(*case(spark), 4, 85)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    joins = [i for i, line in enumerate(lines) if "Join" in line]
    grown = [i for i, line in enumerate(lines) if "Generate" in line]
    assert joins and grown and max(grown) < min(joins)
    # The buckets 10, 11 and 12 have four members each.
    assert any("REPARTITION_BY_NUM" in line and ", 12)" in line for line in lines)

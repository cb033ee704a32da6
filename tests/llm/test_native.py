"""Line dedup, decontamination and mixing: edge cases and SQL oracles."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import contamination, line_dedup, mixing, oracles, queries

from .conftest import DOCS, SF_SMALL, words


def _sorted(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = queries.queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(oracles.oracle_sql()[name])
    assert sorted(want.columns) == sorted(got.columns)
    assert _sorted(got.select(*want.columns).collect()) == _sorted(want.fetchall())


def test_boilerplate_lines_go_site_by_site(spark):
    rows = [(i, f"  Menu \nonly {i}\n\nMenu", "en", "a", 0) for i in range(10)] + [(20 + i, "Menu" if i < 2 else f"text {i}", "en", "b", 0) for i in range(30)]
    got = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, DOCS)).select("row.doc_id", "clean_text", "n_lines", "n_dropped").collect()}
    assert got[3]["clean_text"] == "only 3\n" and got[3]["n_lines"] == 4 and got[3]["n_dropped"] == 2
    assert got[20]["clean_text"] == "Menu" and got[20]["n_dropped"] == 0  # two pages of thirty


def test_line_dedup_edges(spark, edges, empty):
    got = line_dedup.drop_boilerplate(edges)
    assert got.count() == edges.count()
    rows = {(r["row"]["doc_id"], r["row"]["text"]): r for r in got.where("row.doc_id is not null").collect()}
    assert rows[(3, None)]["clean_text"] is None and rows[(3, None)]["n_lines"] == 0
    assert rows[(4, "")]["clean_text"] == "" and rows[(4, "")]["n_dropped"] == 0
    assert rows[(1, rows[(1, got.where("row.doc_id = 1").first()["row"]["text"])]["row"]["text"])]["clean_text"] == ""  # on four of host a's five pages
    assert got.schema["row"].dataType == edges.select(F.struct(*[f"`{c}`" for c in edges.columns]).alias("r")).schema["r"].dataType
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_short_items_are_found_in_long_documents(spark, empty):
    long = words(5, 20_000, 9000)
    items = [(i, " ".join(words(100 + i, n))) for i, n in enumerate((5, 9, 14, 20, 36, 59, 140, 600))] + [(90, "too short"), (91, None), (92, "")]
    rows, want = [], set()
    for k, (i, text) in enumerate(items[:8]):
        own = list(long)
        at = 37 * (k + 1) ** 2
        own[at:at] = text.split()
        rows.append((k, " ".join(own).upper() if k % 2 else ", ".join(own), "en", "s", 0))
        want.add((k, i))
    rows += [(50, " ".join(long), "en", "s", 0), (51, None, None, None, None), (52, "", "en", "s", 0), (0, rows[0][1], "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = contamination.contaminated_documents(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["containment"] == 1.0 for r in got) and len(got) == len(want) + 1  # the repeated row too
    assert {r["doc_id"] for r in contamination.drop_contaminated(docs, bench).collect()} == {50, 51, 52}
    assert contamination.contaminated_documents(empty, bench).count() == 0
    assert contamination.contaminated_documents(docs, bench.limit(0)).count() == 0


def test_containment_threshold_is_exact(spark):
    item = words(7, 40)
    docs = []
    for k, cut in enumerate((0, 4, 7, 8, 20)):  # the last ``cut`` words differ: so many shingles less of 36
        docs.append((k, " ".join(words(200, 500) + item[: 40 - cut] + words(300 + k, 500, 50)), "en", "s", 0))
    got = contamination.contaminated_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))
    assert {r["doc_id"]: r["n_shared"] for r in got.collect()} == {0: 36, 1: 32, 2: 29}  # 28 / 36 is below 0.8


def test_repeated_shingles_do_not_fill_a_sketch(spark):
    item = words(70, 55)  # 51 shingles: blocks of 128, sketches of 48
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    once = spark.createDataFrame([(f"buy{i}",) for i in range(2000)], "w string")
    low = once.orderBy(F.xxhash64("w", "w", "w", "w", "w")).first()["w"]  # its shingle's hash is below the item's
    docs = spark.createDataFrame([(1, " ".join(item + [low] * 77), "en", "s", 0), (2, " ".join([low] * 132), "en", "s", 0)], DOCS)
    got = contamination.contaminated_documents(docs, bench).collect()
    assert [(r["doc_id"], r["n_shared"]) for r in got] == [(1, 51)]


def test_decontamination_edges(spark, edges):
    bench = spark.createDataFrame([(1, " ".join(words(2, 120)[20:60])), (1, None)], "item_id bigint, text string")
    got = contamination.contaminated_documents(edges, bench).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got) == [(False, 1), (False, 2), (False, 2), (True, None)]
    left = contamination.drop_contaminated(edges, bench)
    assert left.columns == edges.columns and left.count() == edges.count() - 4


def test_raking_meets_the_marginals(spark):
    rows = [(i, "w " * 100, "en" if i % 4 else "fr", f"s{i % 3}", 200) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    given = {"source": {"s0": 0.2, "s1": 0.3, "s2": 0.5}, "lang": {"en": 0.6, "fr": 0.4}, "topic": {"article": 1.0, "note": 0.0}}
    cells = mixing.mixed(docs, targets=given, keep=0.3, strict=True, tolerance=1e-4).groupBy("source", "lang").agg(F.first("prob").alias("p"), F.sum("tokens").alias("t")).collect()
    kept = {(r["source"], r["lang"]): r["p"] * r["t"] for r in cells}
    total = sum(kept.values())
    assert abs(total - 0.3 * 60_000) < 1
    for at, shares in ((0, given["source"]), (1, given["lang"])):
        for value, share in shares.items():
            assert abs(sum(w for k, w in kept.items() if k[at] == value) / total - share) < 1e-3


def test_targets_that_cannot_be_met_are_cut_and_told(spark, caplog):
    """s0 has a tenth of the tokens and is asked for half: it gives all it has, the others keep their proportion."""
    rows = [(i, "w " * 100, "en" if i % 4 else "fr", "s0" if i % 10 == 0 else f"s{1 + i % 2}", 200) for i in range(800)]
    docs = spark.createDataFrame(rows, DOCS)
    given = {"source": {"s0": 0.5, "s1": 0.2, "s2": 0.3}}
    base = mixing.mixed(docs).groupBy(*mixing.DIMS).agg(F.sum("tokens").alias("tokens"))
    raked = mixing.rake(base, 0.5, targets=given)
    report = {(r["dim"], r["value"]): r for r in mixing.achieved(*raked).collect()}
    s0, s1, s2 = (report["source", s] for s in ("s0", "s1", "s2"))
    assert abs(s0["target_share"] - 0.5) < 1e-12 and abs(s0["reachable_share"] - 0.2) < 1e-12
    assert abs(s1["reachable_share"] - 0.8 * 0.4) < 1e-12 and abs(s2["reachable_share"] - 0.8 * 0.6) < 1e-12
    assert all(abs(r["achieved_share"] - r["reachable_share"]) < 2e-3 for r in report.values())
    with pytest.raises(mixing.TargetsMissed, match="3 target shares"):
        mixing._told(*raked, True, 0.5, mixing.TOLERANCE)
    with caplog.at_level("WARNING", "tidemark.mixing"):
        drawn = mixing.mixed(docs, targets=given)
        assert "source s0: 0.2" in caplog.text and "of 0.500" in caplog.text
    assert drawn.where("source = 's0' and not sampled").count() == 0  # all it has
    mixing._told(*mixing.rake(base, 0.15, targets=given), True, 0.15, mixing.TOLERANCE)  # fewer documents: within reach
    none = {"source": {"s1": 1.0}}  # values without a share leave the other marginals less to reach
    only = mixing.mixed(docs, targets=none)
    assert only.where("sampled and source <> 's1'").count() == 0 and only.where("prob > 1 or prob < 0").count() == 0


def test_mixing_edges_and_repeatability(spark, edges, empty):
    a, b = (mixing.mixed(edges.repartition(n)).select("row.doc_id", "row.text", "prob", "sampled") for n in (1, 7))
    assert _sorted(a.collect()) == _sorted(b.collect())
    got = mixing.mixed(edges)
    assert got.count() == edges.count()
    assert got.where("prob < 0 or prob > 1 or prob is null").count() == 0
    assert got.where("row.doc_id = 2").select("sampled").distinct().count() == 1  # repeated rows together
    assert got.where("row.source is null").select("source").distinct().collect()[0][0] == "(none)"
    assert mixing.mixed(empty).count() == 0

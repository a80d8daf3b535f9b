"""Corpus steps, sinks and streams."""

import hashlib
import re
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pagework import queries, schemas
from pagework.config import ArticleOptions, Config
from pagework.functions.fingerprints import fingerprint
from pagework.operators import corpus, summary
from pagework.operators.batch import parse_batch, parse_pages
from pagework.operators.engines import Registry, article_engine
from pagework.operators.rules import rule_set, rules_from_list
from pagework.plans.partitions import spread
from pagework.plans.skew import hot_keys, lookup_join
from pagework.sources.rule_files import save_rules
from pagework.sources.rule_versions import RuleVersions
from pagework.sources.sinks import responses_to_json, write_responses, write_text
from pagework.streaming.parse_stream import hot_rules_stream, parse_request_stream, parse_stream, read_page_stream, write_stream

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("min_chars", [1, 5])
def test_paragraph_dedup(spark, min_chars):
    rows = [(p, i, t) for p in range(40) for i, t in enumerate(["same footer", "ab", f"own {p}", "same footer", f"pair {p // 2}"])]
    df = spark.createDataFrame(rows, "page_id BIGINT, pos INT, text STRING").repartition(5, "pos")
    seen, expected = set(), set()
    for p, i, t in sorted(rows):
        if len(t) < min_chars or t not in seen:
            expected.add((p, i, t))
        seen.add(t)
    once = corpus.dedup_paragraphs(df, min_chars)
    assert {tuple(r) for r in once.collect()} == expected
    assert {tuple(r) for r in corpus.dedup_paragraphs(once, min_chars).collect()} == expected
    plan = corpus.dedup_paragraphs(df, min_chars)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert plan.count("HashAggregate") == 2


def test_document_dedup(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (0, 1, "b"), (0, 0, "a"), (2, 0, "c")], "page_id BIGINT, pos INT, text STRING")
    whole = corpus.join_paragraphs(df, "|")
    assert {tuple(r) for r in corpus.dedup_documents(whole).collect()} == {(0, "a|b"), (2, "c")}


def test_fingerprints(spark):
    texts = ["the cat sat on the mat", "", None, "Ünïcode 12 wörds", "the cat sat on the mat!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")

    def simhash(text):
        tokens = [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]
        if not tokens:
            return ""
        hashes = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in tokens]
        value = sum(1 << i for i in range(32) if sum(1 if h >> i & 1 else -1 for h in hashes) > 0)
        return f"{value:08x}"

    got = {r.id: r.fingerprint for r in corpus.fingerprints(df, "id", "text").collect()}
    assert got == {i: simhash(t) for i, t in enumerate(texts)}
    longer = [*texts, "x " * 5000 + "y", "a b c d", "İstanbul straße ½ ² 漢字 and_under", *(f"w{k} v{k * k} same words here" for k in range(200))]
    rows = spark.createDataFrame(list(enumerate(longer)), "id BIGINT, text STRING").selectExpr("id", f"{fingerprint('text')} AS f", "text").collect()
    assert {r.id: r.f for r in rows} == {r.id: r.fingerprint for r in corpus.fingerprints(spark.createDataFrame(rows), "id", "text").collect()}


def article_only():
    return Registry().register("article", article_engine(ArticleOptions()))


def test_fingerprints_on_responses_and_sinks(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = str(tmp_path / "responses")
    write_responses(parse_pages(pages, None, article_only(), Config(engine_order=())), path)
    stored = spark.read.parquet(path)
    got = corpus.with_fingerprints(stored)
    assert got.schema["metadata"].dataType == stored.schema["metadata"].dataType
    assert got.filter("metadata.fingerprint RLIKE '^[0-9a-f]{8}$'").count() == pages.count()
    json = responses_to_json(stored).first().json
    assert '"error":null' in json and '"metadata":{"status_code":null' in json
    write_text(stored.select(F.col("content").alias("text")), str(tmp_path / "texts"))
    back = spark.read.option("lineSep", "\n\f\n").text(str(tmp_path / "texts"))
    assert sorted(r.value for r in back.collect()) == sorted(r.content for r in stored.collect())


def test_stream_equals_batch(spark, tmp_path):
    rules = rule_set(rules_from_list(spark, [{"name": "n", "match_pattern": "example.net", "engine": "article", "css_selector": "h1"}]))
    stream = parse_stream(read_page_stream(spark, SF, "pages.parquet"), rules, registry=article_only(), config=Config(engine_order=()))
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    batch = parse_pages(spark.read.parquet(f"{SF}/pages.parquet"), rules, article_only(), Config(engine_order=()))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


@pytest.mark.parametrize("name", ["f4_parse_stream", "f5_hot_rules"])
def test_streamed_table_may_be_a_folder(spark, tmp_path, name):
    rows = [(i, f"http://www.example.{('com', 'org', 'net')[i % 3]}/de/{i}", f"<html><body><article><h1>Head {i}</h1><p>text {i}</p></article></body></html>") for i in range(12)]
    pages = spark.createDataFrame(rows, schemas.PAGES)
    pages.repartition(4).write.parquet(str(tmp_path / "many" / "pages.parquet"))
    (tmp_path / "one").mkdir()
    pages.coalesce(1).write.parquet(str(tmp_path / "written"))
    shutil.copy(next((tmp_path / "written").glob("part-*.parquet")), tmp_path / "one" / "pages.parquet")
    pages.coalesce(1).write.parquet(str(tmp_path / "one" / "other.parquet"))
    got = [sorted(map(tuple, queries.QUERIES[name](spark, str(tmp_path / kind)).collect())) for kind in ("many", "one")]
    assert [r[0] for r in got[0]] == list(range(12)) and got[0] == got[1]


@pytest.mark.parametrize("name", ["f5_versioned_rules", "f4_request_stream"])
def test_no_task_writes_a_whole_part_of_a_stream(spark, tmp_path, monkeypatch, name):
    """Neither half of the pages, and no part of the captures, passes through one task on its way to the stream."""
    rows = [(i, f"http://www.example.{('com', 'org', 'net')[i % 3]}/de/{i}", f"<html><body><article><h1>Head {i}</h1><p>text {i}</p></article></body></html>") for i in range(240)]
    spark.createDataFrame(rows, schemas.PAGES).repartition(8).write.parquet(str(tmp_path / "pages.parquet"))
    paths = []
    monkeypatch.setattr(queries, "new_path", lambda _, kind: paths.append(str(tmp_path / f"{kind}-{len(paths)}")) or paths[-1])
    got = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(r.pos for r in got) == list(range(240))
    if name == "f5_versioned_rules":
        assert {r.rules_version for r in got if r.pos % 2 == 0} == {1} and {r.rules_version for r in got if r.pos % 2} == {2}
    for path in (p for p in paths if "arriving" in p):
        written = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
        assert max(r["count"] for r in written) < 40


def test_rules_apply_without_restart(spark, tmp_path):
    source, stored = tmp_path / "in", tmp_path / "rules"
    source.mkdir()
    seen = {}

    def write(responses, number):
        seen[number] = {r.rule_matched for r in responses.collect()}

    for number, name in enumerate(["old", "new"]):
        shutil.copy(f"{SF}/pages.parquet", source / f"p{number}.parquet")
        rules = rules_from_list(spark, [{"name": name, "match_type": "regex", "match_pattern": "^http", "engine": "article"}])
        save_rules(rules, str(stored / f"v{number}"))
        hot_rules_stream(read_page_stream(spark, str(source)), str(stored / f"v{number}"), write, str(tmp_path / "cp"),
                         registry=article_only(), config=Config(engine_order=())).awaitTermination()
    assert seen == {0: {"old"}, 1: {"new"}}


def test_one_query_sees_edited_rules(spark, tmp_path):
    """Rules are edited between the batches of one running query. A batch that fails after its rules were replaced
    is repeated by the next query with the version that it had."""
    source, seen, failed = tmp_path / "in", [], []
    source.mkdir()
    for number in range(3):
        shutil.copy(f"{SF}/pages.parquet", source / f"p{number}.parquet")

    def named(name):
        return rules_from_list(spark, [{"name": name, "match_type": "regex", "match_pattern": "^http", "engine": "article"}])

    store = RuleVersions.create(named("one"), str(tmp_path / "rules"))

    def write(responses, number):
        rows = responses.select("rule_matched", "rules_version").distinct().collect()
        if number < 2:
            store.publish(named(("two", "three")[number]))
        if number == 1 and not failed:
            failed.append(rows)
            raise RuntimeError("lost")
        seen.append((number, *rows))

    def start():
        stream = spark.readStream.schema(schemas.PAGES).option("maxFilesPerTrigger", 1).parquet(str(source))
        return hot_rules_stream(stream, store, write, str(tmp_path / "cp"), registry=article_only(), config=Config(engine_order=()))

    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    assert seen == [(0, ("one", 1))] and failed == [[("two", 2)]] and store.current(spark) == 3
    start().awaitTermination()
    assert seen[1:] == [(1, ("two", 2)), (2, ("three", 4))]


@pytest.mark.parametrize("n_rules", [0, 200])
def test_request_stream_equals_batch(spark, tmp_path, n_rules):
    """Captures before and after their requests, out of order, too old, too new, twice and never."""
    minutes = {"early": [-30], "soon": [4], "twice": [-20, -5], "old": [-90], "new": [20], "edge": [10], "never": [], "both": [-90, 3, 20]}
    rows = [(i, f"http://{kind}.example.com/{i}", 60 + 15 * (i % 8)) for i, kind in enumerate(list(minutes) * 3)]
    rows += [(100, "  ", 61), (101, "nope", 62), (102, None, 63), (103, rows[0][1], 61)]
    shots = [(i * 10 + k, url, f"<p>page {i} {k}</p>", at + m) for i, url, at in rows[:24] for k, m in enumerate(minutes[url[7:].split(".")[0]])]
    asked, shot = "pos LONG, url STRING, asked_at LONG", "page_id LONG, url STRING, html STRING, captured_at LONG"

    def files(kind, rows, columns, late):
        """Three files in the order of time but for a few rows that come late, then one that ends all waiting."""
        rows = sorted(rows, key=lambda r: r[3 - (len(r) == 3)])
        far = (-1, "http://end.example.com/", 10_000) if len(rows[0]) == 3 else (-1, "http://end.example.com/", "", 10_000)
        parts = [rows[0::2][: len(rows) // 4], [r for r in rows if r not in rows[0::2][: len(rows) // 4]], [], [far]] if late else [rows[: len(rows) // 2], rows[len(rows) // 2 :], [], [far]]
        for part in filter(None, parts):
            df = spark.createDataFrame(part, columns)
            time = columns.split()[-2]
            df.withColumn(time, F.timestamp_seconds(F.col(time) * 60)).coalesce(1).write.mode("append").parquet(str(tmp_path / kind))
        schema = columns.replace("_at LONG", "_at TIMESTAMP")
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / kind))

    rules = None
    if n_rules:
        entries = [{"name": f"r{k}", "match_pattern": f"h{k}.net"} for k in range(n_rules)] + [{"name": "soon", "match_pattern": "soon.example.com", "engine": "article"}]
        rules = rule_set(rules_from_list(spark, entries))
        assert rules.literal is None
    requests, captures = files("requests", rows, asked, False), files("captures", shots, shot, True)
    got = parse_request_stream(requests, captures, rules, article_only(), Config(engine_order=()), late="300 minutes")
    write_stream(got, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    answered = spark.read.schema(got.schema).parquet(str(tmp_path / "out"))
    at = {i: t for i, _, t in rows}
    near = [s for s in shots for i, url, t in rows if url == s[1] and i < 100 and -60 <= s[3] - at[i] <= 10]
    pages = spark.createDataFrame(near, shot.replace("captured_at LONG", "captured_at LONG"))
    batch = parse_batch(spark.createDataFrame([r[:2] for r in rows], "pos LONG, url STRING"), pages, rules, article_only(), Config(engine_order=()))
    told = {r.pos: r for r in answered.collect()}
    assert answered.count() == len(told) == len(rows)
    assert told == {r.pos: r for r in batch.collect()}
    assert {told[i].success for i in range(24) if "never" in rows[i][1] or "old" in rows[i][1]} == {False} and sum(r.success for r in told.values()) > 10


def test_sketches_stay_within_their_bounds(spark):
    """40,000 URLs in ten batches with overlaps: more than the sketches hold exactly."""
    columns = "engine_used", "rule_matched", "success", "error_code", "url", "content"
    rows = spark.range(60_000).selectExpr("id % 10 AS batch", "'a' AS engine_used", "concat('r', id % 2) AS rule_matched", "true AS success", "CAST(NULL AS STRING) AS error_code",
                                          "concat('http://x/', id % 40000) AS url", "repeat('x', CAST(id % 997 AS INT)) AS content")
    batches = None
    for k in range(10):
        some = summary.outcome_sketches(rows.filter(f"batch = {k}").select(*columns))
        batches = some if batches is None else batches.unionAll(some)
    got = summary.read_sketches(batches, "engine_used").first()
    assert got.n == 60_000 and abs(got.n_urls - 40_000) < 4 * 0.0041 * 40_000
    assert abs(got.chars_50 - 498) <= 4 and abs(got.chars_90 - 897) <= 4 and abs(got.chars_99 - 987) <= 4
    assert {r.rule_matched: r.n for r in summary.merge_sketches(batches, "rule_matched").collect()} == {"r0": 30_000, "r1": 30_000}
    assert summary.read_sketches(batches.limit(0), "engine_used").count() == 0


def test_hot_keys_are_few_and_the_join_is_exact(spark):
    left = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS key")
    right = spark.range(5000).selectExpr("concat('k', id) AS key", "id AS value").union(spark.sql("SELECT 'hot', -1L"))
    assert [r.key for r in hot_keys(left, "key", 100).collect()] == ["hot"]
    got = lookup_join(left, right, "key", F.col("id"), 100, 8)
    expected = left.join(right, "key", "left").select(*got.columns)
    assert got.exceptAll(expected).count() == 0 and got.count() == 5000


def test_tasks_of_large_inputs_hold_so_many_rows(spark):
    """More partitions than cores are no reason to leave any number of rows in one."""
    rows = spark.range(0, 100_000, 1, spark.sparkContext.defaultParallelism)
    dealt = spread(rows, "id")
    assert dealt.count() == 100_000 and dealt.distinct().count() == 100_000
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 5_500
    assert spread(dealt, "id") is dealt

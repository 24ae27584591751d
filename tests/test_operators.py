"""Store, readers, history matrix, merge matrix, semantic helpers and small functions, directly."""

import json

import pytest
from pyspark.sql import functions as F

from granary.functions import banking, standard, typing
from granary.operators import audit, cdc, contract, governance, mdm, reconcile, scd2, store
from granary.plans import semantic
from granary.sources import readers, writers
from granary.streaming.changes import merge_stream


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture()
def table(spark, tmp_path):
    return store.Table(spark, f"file://{tmp_path}/t")


def test_store_versions(spark, table):
    rows = lambda *r: spark.createDataFrame(list(r), "k long, p string, v string")
    assert not table.exists and table.read() is None
    table.create(rows((1, "a", "x"), (2, "b c/d", "y")), ["p"], "B1")
    table.overwrite_partitions(rows((3, "a", "z")), "B2")
    assert pairs(table.read(), "k", "p", "v") == [(2, "b c/d", "y"), (3, "a", "z")]
    table.overwrite_partitions(spark.createDataFrame([], "k long, p string, v string"))
    assert table.read().count() == 2
    table.append(rows((4, None, None)), "B3")
    table.delete("k = 2")
    assert pairs(table.read(), "k") == [(3,), (4,)]
    assert pairs(table.read(partitions={"p": "a"}), "k") == [(3,)]
    assert pairs(table.read(batch="B2"), "k") == [(2,), (3,)] and pairs(table.read(version=0), "k") == [(1,), (2,)]
    table.rollback(0)
    assert pairs(table.read(), "k") == [(1,), (2,)]
    assert [r.operation for r in table.history().orderBy("version").collect()] == ["create", "overwrite_partitions", "overwrite_partitions", "append", "delete", "rollback"]
    assert table.read(timestamp=0.0) is None
    table.replace(spark.createDataFrame([(1,)], "n int"))
    assert table.read().columns == ["n"] and table.read(version=0).columns == ["k", "p", "v"]


def test_store_refuses_a_lost_race(spark, table):
    df = spark.createDataFrame([(1,)], "k int")
    table.create(df)
    entry = table._entry(0)
    table.append(df)
    with pytest.raises(store.CommitConflict):
        table._commit("append", entry["schema"], [], [], 0, None)
    assert table.read().count() == 2


def test_a_failed_write_leaves_the_table_as_it_was(spark, table):
    table.create(spark.createDataFrame([(1,)], "k int"))
    bad = spark.range(4).select(F.when(F.col("id") == 2, F.raise_error(F.lit("planted")).cast("int")).otherwise(F.col("id").cast("int")).alias("k"))
    with pytest.raises(Exception, match="planted"):
        table.overwrite(bad)
    assert pairs(table.read(), "k") == [(1,)] and table.versions() == [0]


def state(spark, *rows):
    df = spark.createDataFrame([(k, v, t, d, b) for k, v, t, d, b in rows], "k long, v string, t string, d boolean, b string")
    return df.select("k", "v", F.to_timestamp("t").alias("_src_ts"), F.sha2("v", 256).alias("_record_hash"), F.col("d").alias("_is_deleted"), F.col("b").alias("_first_batch_id"), F.lit("u").alias("_src_op"))


def test_merge_matrix(spark):
    old, new = "2026-01-02 00:00:00", "2026-01-03 00:00:00"
    target = state(spark, *[(k, "a", old, False, "B1") for k in range(1, 7)])
    source = state(spark, (1, "b", new, False, "B2"), (2, "b", "2026-01-01 00:00:00", False, "B2"), (3, "b", old, False, "B2"), (4, "a", new, False, "B2"), (5, "b", None, False, "B2"), (6, "a2", new, True, "B2"), (7, "n", new, False, "B2"), (8, "n", new, True, "B2"))
    once = cdc.merge(target, source, ["k"])
    want = [(1, "b", False, "B1"), (2, "a", False, "B1"), (3, "b", False, "B1"), (4, "a", False, "B1"), (5, "a", False, "B1"), (6, "a2", True, "B1"), (7, "n", False, "B2")]
    assert pairs(once, "k", "v", "_is_deleted", "_first_batch_id") == want
    assert pairs(cdc.merge(once, source, ["k"]), "k", "v", "_is_deleted", "_first_batch_id") == want
    assert pairs(cdc.merge_exceptions(source, target, ["k"]), "k", "exception") == [(2, "STALE_EVENT"), (7, "UPSERT_UNKNOWN_KEY"), (8, "UPSERT_UNKNOWN_KEY")]


def test_history_matrix(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, untracked string")
    step = lambda h, day, *r, held=None: scd2.step(h, rows(*r) if r else spark.createDataFrame([], "k string, v string, untracked string"), ["k"], ["v"], day, held)
    h = step(None, "2026-01-01", ("same", "1", "x"), ("roll", "1", "x"), ("gone", "1", "x"), ("held", "1", "x"))
    held = spark.createDataFrame([("held",)], "k string")
    h = step(h, "2026-01-02", ("same", "1", "y"), ("roll", "2", "x"), ("new", "1", "x"), held=held)
    show = lambda h: pairs(h, "k", "version", "v", F.col("effective_from").cast("string"), F.col("effective_to").cast("string"), "change_reason", "end_reason", F.array_join("changed_attributes", ","))
    top = "9999-12-31"
    assert show(h) == sorted([("same", 1, "1", "2026-01-01", top, "NEW", None, ""), ("roll", 1, "1", "2026-01-01", "2026-01-01", "NEW", "SUPERSEDED", ""), ("roll", 2, "2", "2026-01-02", top, "CHANGED", None, "v"), ("gone", 1, "1", "2026-01-01", "2026-01-01", "NEW", "REMOVED_AT_SOURCE", ""), ("held", 1, "1", "2026-01-01", top, "NEW", None, ""), ("new", 1, "1", "2026-01-02", top, "NEW", None, "")], key=repr)
    assert h.where("k = 'same'").first().untracked == "x"
    again = step(h, "2026-01-02", ("same", "1", "y"), ("roll", "3", "x"), ("new", "1", "x"), held=held)
    assert ("roll", 2, "3", "2026-01-02", top, "CHANGED", None, "v") in show(again) and len(show(again)) == len(show(h))
    third = step(h, "2026-01-03", ("gone", "2", "x"), held=held)
    assert ("gone", 2, "2", "2026-01-03", top, "REAPPEARED", None, "v") in show(third)
    assert third.select("surrogate_key").distinct().count() == third.count()
    with pytest.raises(Exception, match="already goes beyond"):
        step(third, "2026-01-01", ("same", "1", "y")).collect()


def test_readers(spark, tmp_path):
    one = str(tmp_path)
    writers.write_dump(tmp_path / "d.sql", {"t": (["a", "b"], [(1, "it's, (a) \\ \n x"), (None, "NULL"), (3, "")]), "u": (["z"], [(9,)])})
    got = readers.read_dump(spark, f"{one}/d.sql", "t", ["b", "a", "missing"]).collect()
    assert [(r._source_row, r.a, r.b, r.missing) for r in got] == [(1, "1", "it's, (a) \\ \n x", None), (2, None, "NULL", None), (3, "3", "", None)]
    assert list(readers.tuples(r"(1,'a''b\'c', NULL ),( 'x',-2.5)")) == [["1", "a'b'c", None], ["x", "-2.5"]]
    (tmp_path / "p.csv").write_text("id|amount|note\n1|5.50|\n\n2|5.00|x\nT|3|10.50\n")
    assert [tuple(r) for r in readers.read_psv(spark, f"{one}/p.csv", ["note", "id", "none"]).orderBy("_source_row").collect()] == [("p.csv", 2, None, "1", None), ("p.csv", 4, "x", "2", None)]
    s = readers.psv_stats(spark, f"{one}/p.csv").first()
    assert (s.header, s.data_lines, s.trailer_count, float(s.trailer_total)) == ("id|amount|note", 2, 3, 10.5)
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{bad\n')
    assert pairs(readers.read_jsonl(spark, f"{one}/l.jsonl"), "_source_row", "_parse_error") == [(1, None), (3, "MALFORMED_JSON")]
    (tmp_path / "a.json").write_text('[{"a": 1}, {"b": [2, null]}]')
    (tmp_path / "b.json").write_text("[{")
    assert pairs(readers.read_json_array(spark, [f"{one}/a.json", f"{one}/b.json"]), "_source_row", "payload", "_parse_error") == [(0, "[{", "MALFORMED_JSON"), (1, '{"a":1}', None), (2, '{"b":[2,null]}', None)]
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "s.png").write_bytes(writers.png(48, 30))
    (docs / "m.eml").write_text("hello")
    (docs / "_skip.txt").write_text("x")
    read = readers.read_documents(spark, str(docs))
    width, height = banking.png_size(F.col("content"))
    assert pairs(read.select("file_name", "mime_type", "text_content", F.when(F.col("file_name") == "s.png", width).alias("w"), F.when(F.col("file_name") == "s.png", height).alias("h")), "*") == [("m.eml", "message/rfc822", "hello", None, None), ("s.png", "image/png", None, 48, 30)]
    lost = readers.with_missing_files(read, spark.createDataFrame([("m.eml", 5, "h"), ("lost.eml", 0, "h")], "file string, bytes long, sha256 string"))
    assert pairs(lost, "file_name") == [("lost.eml",), ("m.eml",), ("s.png",)]
    with pytest.raises(ValueError):
        readers.raw_frame(spark, {"format": "xls", "files": "*", "columns": []}, one)


def test_streaming_merge(spark, tmp_path):
    c = {"table": "users", "key": ["k"], "columns": [{"name": "k", "type": "bigint"}, {"name": "v", "type": "string"}]}
    event = lambda op, k, v, ts: json.dumps({"op": op, "ts_ms": ts, "source": {"table": "users", "file": "b", "pos": ts}, "before": {"k": k, "v": v} if op == "d" else None, "after": None if op == "d" else {"k": k, "v": v}})
    (tmp_path / "in").mkdir()
    t = store.Table(spark, f"file://{tmp_path}/state")
    for name, lines in (("1.jsonl", [event("c", 1, "a", 10), event("c", 2, "b", 11)]), ("2.jsonl", [event("u", 1, "late", 5), event("d", 2, "b", 20), event("c", 3, "c", 21)])):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        merge_stream(spark, str(tmp_path / "in"), t, c, str(tmp_path / "cp")).awaitTermination()
    assert pairs(t.read(), "k", "v", "_is_deleted") == [(1, "a", False), (2, "b", True), (3, "c", False)]


def test_semantic_helpers():
    assert semantic.statements("-- c\nSELECT 1;\nSELECT ';' AS x;\n") == ["SELECT 1", "SELECT ';' AS x"]
    assert semantic.named_blocks("-- name: a\nSELECT 1;\n-- name: b\nSELECT 2;\n") == {"a": "SELECT 1", "b": "SELECT 2"}
    with pytest.raises(ValueError):
        semantic.render("SELECT ${nothing}", {}, "")
    assert semantic.visual_sql("v", {"r": "[region]"}, {"n": "SUM([x])"}, ["[x] > 0"], 5) == "SELECT region AS r, SUM(x) AS n FROM v WHERE ([x] > 0) GROUP BY region LIMIT 5".replace("[x]", "x")
    assert semantic.missing_columns(["SUM([a])", "[b]"], ["a"]) == ["b"]
    for view in semantic.QUERIES:
        assert not any(w in semantic.render(semantic.VIEWS[view], {t: t for t in semantic.TABLES}, "{a} - {b}").upper() for w in (" EXCEPT ", " QUALIFY ", "LATERAL VIEW", "`"))


def test_rules_and_masks(spark):
    a, b, c = (dict(candidate_id=i, src_system=s, src_key=i, name_std=n, name_key=n, pan_std=p, dob="1980", mobile_e164=m, pincode_std=z, cbs_ref=r, is_active=True) for i, s, n, p, m, z, r in (("1", "CBS", "RAVI SHARMA", "P1", "M1", "Z", None), ("2", "LMS", "RAVI SHARMA", "P2", "M1", "Z", "1"), ("3", "CRM", "RAVI SHARMX", None, None, "Z", None)))
    df = spark.createDataFrame([tuple(x.values()) for x in (a, b, c)], "candidate_id string, src_system string, src_key string, name_std string, name_key string, pan_std string, dob string, mobile_e164 string, pincode_std string, cbs_ref string, is_active boolean")
    got = {(r.id_a, r.id_b): (r.rule, r.decision) for r in mdm.decide(mdm.features(mdm.block(df), df)).collect()}
    assert got == {("1", "2"): ("PAN_CONFLICT", "NO_MATCH"), ("1", "3"): ("NAME_DOB", "REVIEW"), ("2", "3"): ("NAME_DOB", "REVIEW")}
    one = spark.createDataFrame([("AB12-9",)], "x string")
    shown = [one.select(governance.mask(F.col("x"), k).cast("string")).first()[0] for k in ("LAST_4", "REDACT", "NULL")]
    assert shown == ["xx12-9", "xxnn-n", None]
    assert governance.tag_changes({"a": "G_X"}, {"a": ["OTHER"], "b": ["G_Y", "Z"]}, "G_") == ([("a", "G_X")], [("b", "G_Y")])
    assert governance.verdict("A", "A", 1) == "agree" and governance.verdict(None, None, 0) == "empty"
    with pytest.raises(ValueError):
        governance.mask(F.col("x"), "?")


def test_small_functions(spark):
    df = spark.createDataFrame([("Dr. MOHD  O'Neil", "0 98765-43210", "ABCDE1234F", " A@b.Co ", "12 MG. Rd., Nr. Ngr", "x 5600011 y")], "n string, m string, p string, e string, a string, z string")
    got = tuple(df.select(standard.name(F.col("n")), standard.mobile(F.col("m")), standard.pan(F.col("p")), standard.email(F.col("e")), standard.address(F.col("a")), standard.pincode(F.col("z"))).first())
    assert got == ("MOHAMMED O NEIL", "+919876543210", "ABCDE1234F", "a@b.co", "12 MG ROAD NEAR NAGAR", "560001")
    v = spark.createDataFrame([("1.7",), (" ",), ("x",), ("31/12/2025",)], "v string")
    assert [tuple(r) for r in v.select(typing.typed(F.col("v"), "int"), typing.typed(F.col("v"), "date", ["yyyy-MM-dd", "dd/MM/yyyy"]).cast("string")).collect()] == [(1, None), (None, None), (None, None), (None, "2025-12-31")]
    s = spark.createDataFrame([(10.0, 10.0, 0.0), (10.0, 8.0, -2.0), (10.0, 8.0, 0.0)], "e double, a double, x double")
    assert [r[0] for r in s.select(reconcile.status(F.col("e"), F.col("a"), F.col("x"))).collect()] == ["MATCHED", "EXPLAINED", "MISMATCH"]
    assert contract.header_drift(["a", "x"], {"columns": [{"name": "a"}, {"name": "b"}]}) == [("NEW_COLUMN", "x"), ("MISSING_COLUMN", "b")]
    assert audit.error_summary(ValueError("a\nCaused by: java.lang.IllegalStateException: inner\n\tat x")) == "Caused by: java.lang.IllegalStateException: inner"


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    rows = [(i, f"it's {i}, (so)" if i % 3 else None) for i in range(3000)]
    one = f"file://{tmp_path}"
    for name, part in (("x", rows), ("y", rows[:7])):
        (tmp_path / f"{name}.csv").write_bytes(b"id|note\r\n" + b"".join(b"\r\n" * (i == 5) + f"{i}|{v or ''}\r\n".encode() for i, v in part) + f"T|{len(part)}|".encode())
        writers.write_dump(tmp_path / f"{name}.sql", {"u": (["z"], [(1,)]), "t": (["id", "note"], part)}, most=10)
    bound = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        csv, sql = readers.read_psv(spark, f"{one}/*.csv", ["id", "note"]), readers.read_dump(spark, f"{one}/*.sql", "t", ["note", "id"])
        assert csv.select(F.spark_partition_id()).distinct().count() > 8
        for file, part in (("x", rows), ("y", rows[:7])):
            assert [tuple(r) for r in csv.where(F.col("_source_file") == f"{file}.csv").orderBy("_source_row").collect()] == [(f"{file}.csv", i + 2 + (i >= 5), str(i), v) for i, v in part]
            assert [tuple(r) for r in sql.where(F.col("_source_file") == f"{file}.sql").orderBy("_source_row").collect()] == [(f"{file}.sql", i + 1, v, str(i)) for i, v in part]
        assert {tuple(r) for r in readers.psv_stats(spark, f"{one}/*.csv").select("_source_file", "header", "data_lines", "trailer_count").collect()} == {("x.csv", "id|note", 3000, 3000), ("y.csv", "id|note", 7, 7)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bound)


def test_dump_values_keep_their_places():
    from granary.sources.readers import tuples

    assert list(tuples("(1,,'a'),(null,'b''c\\n', NULL ),( 5 ,'x,(y)','')")) == [["1", "", "a"], [None, "b'c\n", None], ["5", "x,(y)", ""]]


def test_key_drift_is_by_entity():
    from granary.operators.contract import known_keys
    from granary.sources.contracts import CONTRACTS

    assert "profile" in known_keys(CONTRACTS["crm_customer"]) and "profile" not in known_keys(CONTRACTS["pay_transaction"])
    assert "before" not in known_keys(CONTRACTS["pay_transaction"])


def test_ranked(spark):
    from granary.operators.relational import ranked

    rows = [(i, float(i * 7919 % 50)) for i in range(500)] + [(1000, None)]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = ranked(spark.createDataFrame(rows, "id int, v double"), "v", "id", ranges=16).orderBy("place").collect()
    assert [(r.id, r.v) for r in got] == want and [r.place for r in got] == list(range(1, 502))
    assert ranked(spark.createDataFrame([], "id int, v double"), "v", "id").collect() == []


def test_commits_are_whole_and_exclusive(spark, tmp_path):
    from granary.operators.store import CommitConflict, Table

    t = Table(spark, f"file://{tmp_path}/t")
    t.create(spark.range(3))
    with pytest.raises(CommitConflict):
        t._commit("append", t._current()["schema"], [], [], None, None)
    t.append(spark.range(2))
    assert t.versions() == [0, 1] and t.read().count() == 5
    assert not [x for x in (tmp_path / "t" / "_log").iterdir() if x.name.startswith("_")]


def test_an_instant_with_two_states(spark):
    from granary.operators import audit

    rows = spark.createDataFrame([("b", "silver", "*", s) for s in ("COMPLETED", "STARTED")], "batch_id string, stage string, entity string, status string").selectExpr("*", "TIMESTAMP '2026-01-01 00:00:00' AS at")
    audit.require_completed(rows, "b", "silver")


def test_cut_forgets_estimates(spark):
    """Estimates that grow with every round of joins became numbers of megabytes, and the driver ran out of memory."""
    from granary.operators.relational import cut

    df = cut(spark.range(100).select("id", F.col("id").alias("v")))
    for _ in range(3):
        df = cut(df.join(df.withColumnRenamed("v", "w"), "id").groupBy("id").agg(F.min("w").alias("v")))
    assert df.count() == 100
    assert int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 20


def test_components_of_long_chains(spark):
    """Labels that had to walk back through a run of 60 rising nodes one by one weren't stable after 50 rounds."""
    chain = [run + 1000 * step for run in range(3, -1, -1) for step in range(60)]
    nodes = spark.createDataFrame([(n,) for n in [*chain, 99]], "node long")
    found = mdm.components(nodes, spark.createDataFrame([*zip(chain, chain[1:], strict=False), (99, 99), (5, 99)], "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {*((n, 0) for n in chain), (99, 99)}


def test_lines_are_numbered_without_python(spark, tmp_path):
    """Whole lines went to Python for their numbers and were sorted to be counted."""
    (tmp_path / "a.txt").write_text("".join(f"line {i}{chr(13) * (i % 3 == 0)}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = readers._lines(spark, f"file://{tmp_path}/*.txt", header=True)
        assert "MapInArrow" not in (plan := lines._jdf.queryExecution().toString()) and "SortAggregate" not in plan
        rows = lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["_source_row"], r["line"]) for r in rows) == [(i, f"line {i}") for i in range(1, 5001)] and {r["_header"] for r in rows} == {"line 1"}


def test_repeated_keys_do_not_shuffle_rows(spark):
    """Every row was shuffled to meet the keys that are there more than once."""
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d"), (None, "e")], "k string, v string")
    checked = contract.validate(rows, {"key": ["k"], "columns": [{"name": "k"}, {"name": "v"}]})
    assert {r["v"] for r in checked.where("size(_warnings) > 0").collect()} == {"b", "c", "d", "e"}
    assert "SortMergeJoin" not in (plan := checked._jdf.queryExecution().executedPlan().toString()) and "hashpartitioning" not in plan

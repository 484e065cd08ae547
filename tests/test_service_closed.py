"""The SQL service: what is refused, what still runs, and what is cut off."""

import pytest

from tabloom.plans.service import Service

FILE = "text.`/etc/hostname`"
REFLECT = "reflect('java.lang.System', 'getenv', 'PATH')"


@pytest.fixture(scope="module")
def service(spark):
    def build(session):
        session.range(100).selectExpr("id", "id % 3 AS k", "array(id, 2) AS a", "named_struct('x', id) AS s", "string(id) AS t", "timestamp_seconds(id) AS ts").createOrReplaceTempView("numbers")
        session.range(3).createOrReplaceTempView("hidden")
        session.udf.register("secret", lambda x: str(x))
        return ["numbers"]

    return Service(spark, build)


@pytest.mark.parametrize("sql", [
    # names that only analysis resolves, and statements that run while they are analysed
    f"SELECT IDENTIFIER('reflect')('java.lang.System', 'getenv', 'PATH')", f"SELECT * FROM IDENTIFIER('{FILE}')", f"EXECUTE IMMEDIATE 'SELECT * FROM {FILE}'", f'EXECUTE IMMEDIATE "SELECT {REFLECT}"',
    "SELECT IDENTIFIER('id') FROM numbers", "SELECT * FROM IDENTIFIER('hidden')", "EXECUTE IMMEDIATE 'SELECT 1'", "SELECT IDENTIFIER('sec' || 'ret')(id) FROM numbers",
    # every place that a table or function can stand in
    f"FROM {FILE}", f"FROM {FILE} |> LIMIT 1", f"FROM numbers |> UNION ALL (SELECT id, k, a, s, t, ts FROM hidden)", f"FROM numbers |> SELECT {REFLECT}", f"FROM numbers |> JOIN hidden USING (id)", f"FROM numbers |> WHERE id IN (SELECT id FROM hidden)",
    f"SELECT * FROM numbers, LATERAL (SELECT * FROM {FILE})", f"SELECT * FROM numbers, LATERAL (SELECT {REFLECT})", "SELECT * FROM numbers JOIN LATERAL (SELECT * FROM hidden h WHERE h.id = numbers.id)",
    f"SELECT (SELECT max(value) FROM {FILE})", f"SELECT * FROM numbers WHERE EXISTS (SELECT 1 FROM {FILE})", f"SELECT * FROM numbers WHERE t IN (SELECT value FROM {FILE})", "SELECT * FROM numbers WHERE id = (SELECT max(id) FROM hidden)",
    f"WITH a AS (SELECT * FROM {FILE}) SELECT 1", f"WITH a AS (WITH b AS (SELECT * FROM {FILE}) SELECT * FROM b) SELECT * FROM a", "WITH numbers AS (SELECT * FROM hidden) SELECT * FROM numbers", "WITH a AS (SELECT * FROM b), b AS (SELECT 1) SELECT * FROM a",
    "SELECT TRANSFORM(id) USING 'cat' FROM numbers", "FROM numbers MAP id USING 'cat' AS x", "FROM numbers REDUCE id USING 'cat' AS x",
    f"SELECT sum({REFLECT}) OVER () FROM numbers", f"SELECT k, count(*) FROM numbers GROUP BY k HAVING max({REFLECT}) <> ''", f"SELECT * FROM numbers LATERAL VIEW explode(array({REFLECT})) e AS x", f"SELECT nvl(NULL, {REFLECT})",
    f"SELECT * FROM VALUES ({REFLECT}) AS v(x)", f"SELECT * FROM numbers PIVOT (max({REFLECT}) FOR k IN (0, 1))", f"SELECT aggregate(a, 0L, (x, y) -> x + length({REFLECT})) FROM numbers", f"SELECT CASE WHEN id > 1 THEN {REFLECT} END FROM numbers",
    "SELECT * FROM hidden", "SELECT * FROM global_temp.numbers", "SELECT * FROM spark_catalog.default.numbers", "SELECT secret(id) FROM numbers", "SELECT * FROM read_files('/etc')", "SELECT * FROM sql_keywords()",
    # commands and scripts
    "BEGIN SELECT 1; END", "DECLARE VARIABLE x INT", "SET VAR x = 1", "DESCRIBE numbers", "SHOW TABLES", "EXPLAIN SELECT 1", "CREATE TEMP VIEW x AS SELECT 1", "ADD JAR '/x.jar'", "REFRESH TABLE numbers", "SELECT * FROM numbers; DROP VIEW numbers", "ANALYZE TABLE numbers COMPUTE STATISTICS", "TRUNCATE TABLE numbers",
    "SELECT current_user()", "SELECT current_catalog()", "SELECT input_file_name() FROM numbers", "SELECT spark_partition_id() FROM numbers", "SELECT raise_error('x')", "SELECT uuid()",
])
def test_refused(service, sql):
    got = service.query_sql(sql)
    assert "error" in got, got
    assert "PATH" not in got["error"] or "reflect" in got["error"].lower()


@pytest.mark.parametrize("sql, first", [
    ("SELECT count(*), sum(id), avg(k), max_by(t, id), approx_count_distinct(k), percentile(id, 0.5), collect_set(k)[0] IS NOT NULL FROM numbers", [100, 4950, 0.99, "99", 3, 49.5, True]),
    ("FROM numbers |> WHERE k = 1 |> AGGREGATE count(*) AS n GROUP BY k |> SELECT n", [33]),
    ("WITH a AS (SELECT id FROM numbers), b AS (SELECT max(id) AS m FROM a) SELECT m, (SELECT min(id) FROM a) FROM b", [99, 0]),
    ("WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 5) SELECT max(n) FROM r", [5]),
    ("SELECT n.id, l.y FROM numbers n, LATERAL (SELECT n.id + 1 AS y) l WHERE n.id = 4", [4, 5]),
    ("SELECT id, e.x FROM numbers LATERAL VIEW explode(a) e AS x WHERE id = 7 ORDER BY x", [7, 2]),
    ("SELECT * FROM (SELECT k, id FROM numbers) PIVOT (count(id) FOR k IN (0, 1, 2))", [34, 33, 33]),
    ("SELECT k, sum(id) AS n FROM numbers GROUP BY ROLLUP(k) ORDER BY k NULLS FIRST", [None, 4950]),
    ("SELECT b.id FROM numbers x JOIN numbers b USING (id) WHERE NOT EXISTS (SELECT 1 FROM numbers c WHERE c.k = b.k AND c.id > b.id) ORDER BY b.id", [97]),
    ("SELECT nvl(NULL, 3), ifnull(NULL, 1), left('abc', 2), CASE WHEN 1 < 2 THEN 'x' END, CAST('7' AS INT) + 1, try_cast('a' AS INT), substr('abc', 2), 'a' || 'b', s.x, a[1], date_trunc('day', ts) IS NOT NULL, DATE '2024-01-02' - DATE '2024-01-01' > INTERVAL '1' HOUR, id BETWEEN 0 AND 1, t LIKE '0%', t RLIKE '^0', id IN (0, 5) FROM numbers ORDER BY id LIMIT 1", [3, 1, "ab", "x", 8, None, "bc", "ab", 0, 2, True, True, True, True, True, True]),
    ("SELECT row_number() OVER (PARTITION BY k ORDER BY id DESC) AS r, lag(id) OVER (ORDER BY id) FROM numbers ORDER BY id LIMIT 1 OFFSET 3", [33, 2]),
    ("SELECT * FROM range(3) EXCEPT SELECT * FROM range(2)", [2]), ("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS v(x, y) ORDER BY x DESC", [2, "b"]), ("SELECT /*+ BROADCAST(n) */ n.id FROM numbers n WHERE id = 3", [3]),
    ("SELECT from_json('{\"a\": 1}', 'a INT').a, get_json_object('{\"a\": 2}', '$.a'), to_json(s), sha2('x', 256) IS NOT NULL, regexp_replace('abc', 'b', ''), split('a,b', ',')[1], round(2.567, 1), transform(a, x -> x + 1)[0], filter(a, x -> x > 1)[0], map('k', 1)['k'] FROM numbers WHERE id = 1", [1, "2", '{"x":1}', True, "ac", "b", 2.6, 2, 2, 1]),
])
def test_queries_still_run(service, sql, first):
    got = service.query_sql(sql)
    assert got.get("rows", got)[0] == first


def test_a_wide_result_is_cut_off(spark, service):
    small = Service(spark, service.build, result_bytes=10_000)
    got = small.query_sql("SELECT id, repeat('x', 999) AS w FROM numbers ORDER BY id", 50)
    assert got["truncated"] and 0 < got["row_count"] < 11 and [r[0] for r in got["rows"]] == list(range(got["row_count"]))
    assert small.query_sql("SELECT repeat('x', 20000) AS w") == {"columns": ["w"], "rows": [], "row_count": 0, "truncated": True}
    assert not small.query_sql("SELECT id FROM numbers", 200)["truncated"]
    assert small.query_sql("SELECT 1 AS a, 2 AS a")["rows"] == [[1, 2]]


def test_a_large_scan_is_refused(spark, tmp_path):
    spark.range(200_000).write.parquet(str(tmp_path / "t"))
    build = lambda s: (s.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("t"), ["t"])[1]
    assert "bytes" in Service(spark, build, input_bytes=1000).query_sql("SELECT count(*) FROM t")["error"]
    assert "bytes" in Service(spark, build, input_bytes=1000).query_sql("SELECT 1 WHERE EXISTS (SELECT 1 FROM t WHERE id = 5)")["error"]
    assert Service(spark, build).query_sql("SELECT count(*) FROM t")["rows"] == [[200_000]]

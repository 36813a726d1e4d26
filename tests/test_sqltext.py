import random

from pyspark.sql import functions as F

from colweave.functions import sqltext as T


def masked(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, sql string")
    rows = {r.i: r.masked for r in T.mask_literals(df).collect()}
    return [rows[i] for i in range(len(texts))]


def test_masking(spark):
    texts = [
        "SELECT 'secret', 42, 1.5e-3, a1 FROM x",
        "SELECT `secret 1`, \"dbl 2\", [br 3] FROM `proj.ds.t`",
        "SELECT 'O''Brien' FROM x WHERE y = 'z'",
        "SELECT 'O\\'Brien', ['in 1 list']",
        "",
    ]
    assert masked(spark, texts) == [
        "SELECT '<REDACTED>', 0, 0, a1 FROM x",
        "SELECT `secret 1`, \"dbl 2\", [br 3] FROM `proj.ds.t`",
        "SELECT '<REDACTED>' FROM x WHERE y = '<REDACTED>'",
        "SELECT '<REDACTED>', ['in 1 list']",
        "",
    ]


#: Pieces of SQL and what becomes of each.
PIECES = [
    ("'plain'", T.MASK), ("'two ''quotes'' in'", T.MASK), ("'a \\' b'", T.MASK), ("'7 [x] `y`'", T.MASK), ("''", T.MASK),
    ("`t 1`.`c 2`", "`t 1`.`c 2`"), ('"Col 9"', '"Col 9"'), ("[dbo 3]", "[dbo 3]"), ("42", "0"), ("0.5e+10", "0"), ("x1", "x1"),
    ("é9", "é9"), ("\x003\x00", "\x000\x00"), ("\x00q0\x00", "\x00q0\x00"), ("a.b", "a.b"), ("$", "$"), ("\\", "\\"),
]


def test_masking_of_composed_texts(spark):
    rng = random.Random(11)
    chosen = [[rng.choice(PIECES) for _ in range(rng.randint(0, 12))] for _ in range(800)]
    texts = [" , ".join(p[0] for p in c) for c in chosen]
    assert masked(spark, texts) == [" , ".join(p[1] for p in c) for c in chosen]


def test_masking_of_open_literals(spark):
    cases = {
        "a = 'x 1": "a = 'x 0",
        "'a' b 'c 2": "'<REDACTED>' b 'c 0",
        "'a''": "'<REDACTED>''",
        "'it''s 5": "'<REDACTED>''s 0",
        "'a\\' 6": "'<REDACTED>' 0",
            "it's `b 1` 2": "it's `b 1` 0",
    }
    got = masked(spark, list(cases))
    assert dict(zip(cases, got, strict=True)) == cases


def test_masking_of_long_literals(spark):
    million = 1_000_000
    texts = ["x = '" + "a" * million + "' y 1", "'" + "''" * million + "'", "'" + "'' " * 5_000, "1 " * 50_000]
    assert masked(spark, texts) == ["x = '<REDACTED>' y 0", "'<REDACTED>'", "'<REDACTED>'' ", "0 " * 50_000]


def test_masking_runs_no_python(spark):
    df = spark.createDataFrame([("select 1",)], "sql string")
    assert "Python" not in T.mask_literals(df)._jdf.queryExecution().executedPlan().toString()


def test_normalized_text_and_key(spark):
    texts = ["select  a\n\tfrom b ", "select a from b", "select a from b -- c", "SELECT a from b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, sql string")
    lit = F.lit
    key = lambda d, v: T.cache_key(F.col("sql"), lit(d), lit("m"), lit("p"), lit(v))
    rows = df.select("i", T.normalize_sql(F.col("sql")).alias("n"), key("d", "1").alias("k"), key("e", "1").alias("e"), key("d", "2").alias("v")).collect()
    rows = sorted(rows, key=lambda r: r.i)
    assert rows[0].n == rows[1].n == "select a from b"
    assert rows[0].k == rows[1].k
    assert len({rows[1].k, rows[2].k, rows[3].k, rows[1].e, rows[1].v}) == 5


def test_marker_order_and_excerpt(spark):
    texts = ["x" * 50 + "exec sp_executesql @a" + "y" * 50, "execute sp_executesql; EXECUTE IMMEDIATE z", "select 1", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, sql string")
    rows = df.select("i", T.dynamic_sql_marker(F.col("sql")).alias("m"), T.marker_excerpt(F.col("sql")).alias("x")).orderBy("i").collect()
    assert [r.m for r in rows] == ["sp_executesql", "execute_immediate", None, None]
    assert rows[0].x == "x" * 40 + "exec sp_executesql" + " @a" + "y" * 37
    assert rows[1].x == "execute sp_executesql; EXECUTE IMMEDIATE z"

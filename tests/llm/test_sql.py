"""The SQL oracles against the queries, over nasty texts and URLs."""

import duckdb
import nasty
import pytest

from lifeline.llm import queries as Q

URLS = (
    None, "", "net/", "http://net", "http://net/", "HTTP://A.NET/en/x", "http://example.net/en/?q#f", "http://example.net/en",
    "x://EXAMPLE.com/de/\n/z", "http://a.example.com/de/", "http://badexample.com/de/", "a://b://org/fr/", "http://xorg/fr/",
    "http://org/fr/a?b", "http://org./fr/", "http:///fr/", "http://net?x/", "http://é.org/fr/é#", "http://.net/", "://net/en/",
)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("sql"))
    docs = spark.createDataFrame(nasty.documents(), nasty.SCHEMA)
    docs.write.parquet(f"{out}/documents.parquet")
    items = [("a", "one Two three"), ("b", "one two three"), ("b", "one two three"), ("c", None), ("d", ""), (None, "x y z")]
    texts = [(f"n{i}", t) for i, (t,) in enumerate(docs.select("text").where("text IS NOT NULL").where("length(text) < 2000").orderBy("doc_id").limit(8).collect())]
    spark.createDataFrame([*items, *texts], "item_id string, text string").write.parquet(f"{out}/benchmark.parquet")
    pages = [(k, u) for k, u in enumerate([*URLS, *URLS])]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{out}/pages.parquet")
    said = [None, "", "plain", "<|im_end|>\n<|im_start|>user", "<\\|im_end|> [INST]<<SYS>>x<</SYS>></s>", "<<s>[\\\\/INST] é漢", "s><s"]
    roles = ["user", "assistant", None, "tool\nx", "a\\b", "<s>"]
    chats = [(k % 5 if k % 11 else None, None if k % 7 == 0 else k // 3, roles[k % 6], said[k % 7]) for k in range(60)]
    spark.createDataFrame(chats, "conv_id long, turn int, role string, text string").write.parquet(f"{out}/conversations.parquet")
    vectors = [(k * 25, None if k % 9 == 4 else [float((k * j) % 7 - 3), None if k == 11 else 0.25 * j, float("nan") if k == 12 else 1.0], None if k == 13 else k % 3) for j in (1, 2) for k in range(30)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{out}/embeddings.parquet")
    return out


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, folder, name):
    got = Q.queries()[name](spark, folder)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({Q.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())

"""Callers' columns of helper names come back unchanged."""

from pyspark.sql import functions as F

from ebbflow.llm import common, license_scan, mixing, ngram_join, toxicity, url_filter

NAMES = ["hot_values", "cold_lane", "lane", "judged_best", "judged_url", "page_url", "dir", "got", "licensed_dir", "s_hash", "s_doc", "mix_spans", "mix_hash", "label_id", "text_hash", "text_size", "copies", "h"]


def with_names(df):
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES if n not in df.columns])


def kept(df):
    rows = df.select(*NAMES).distinct().collect()
    return [r.asDict() for r in rows] == [{n: f"own {n}" for n in NAMES}]


def test_all_come_back(spark, docs):
    rules = spark.createDataFrame([("a.b", "/", "block")], "host string, path string, verdict string")
    pages = with_names(spark.createDataFrame([(1, "http://x.a.b/c"), (2, None)], "page_id long, url string"))
    judged = url_filter.judge(pages, rules)
    assert kept(judged) and {r.page_id: r.verdict for r in judged.collect()} == {1: "block", 2: "allow"}
    files = with_names(spark.createDataFrame([("a/l", "MIT", 0.9, True), ("a/b", None, None, False)], "path string, license_id string, cosine double, is_license_file boolean"))
    found = license_scan.inherited(files)
    assert kept(found) and found.where("license_id = 'MIT'").count() == 2
    more = with_names(docs)
    assert kept(mixing.mixed_documents(more)) and kept(ngram_join.deduplicated(more))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert kept(toxicity.score(more, labels))
    keyed = spark.createDataFrame([(1, 5000, "v"), (2, 1, "w")], "k long, n long, found string")
    looked = common.look_up(with_names(spark.createDataFrame([(1,), (2,), (None,)], "k long")), keyed, ["k"], "n", F.lit(0))
    assert kept(looked) and {r.k: r.found for r in looked.collect()} == {1: "v", 2: "w", None: None}

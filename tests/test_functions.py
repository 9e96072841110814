import math
import random

import numpy as np
from pyspark.sql import functions as F

from docloom.functions import ids as I
from docloom.functions import measures as M
from docloom.functions import text as T
from docloom.operators import metrics as X
from docloom.operators import quantiles as Q
from docloom.operators import validation as V


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_word_count_is_python_split(spark):
    odd = "a\x1cb\x1dc\x85d\xa0e f g h i j　k\x0bl\x0cm​n"
    values = ["", " ", "one", " two  words ", odd, None, "\ttab\nline\r\n"]
    assert column(spark, values, T.word_count) == [len(v.split()) if v else 0 for v in values]
    assert column(spark, values, T.strip) == [v.strip() if v is not None else None for v in values]
    assert column(spark, ["é𝄞x", None], T.char_count) == [3, 0]


def test_cleaning(spark):
    values = ["see http://a.b/c?d=e now", "www.x.y", "12.3, (4)", "a\x00bc\n\n\n  d  e", None, "x y"]
    assert column(spark, values, T.clean) == ["see now", "", "", "abc\nd e", "", ""]
    assert column(spark, [" a\nb\n\na \n c"], T.distinct_lines) == ["a\nb\nc"]
    assert column(spark, ["One. Two!  Three"], T.sentences) == [["One.", "Two!", "Three"]]


def test_ids(spark):
    values = ["202302105", "L_202401015", "202490015", "20240101", "", "202", None, "2O2401015"]
    assert column(spark, values, I.valid_document_id) == [True, True, False, False, False, False, False, False]
    values = ["A/2023/1234", "B/2024/5678/XYZ", "ST/11940/2023/INIT", "INVALID FORMAT", "1234/5678", "A/B/C", " C/2020/1 "]
    assert column(spark, values, I.normalise_identifier) == ["A/2023/1234", "B/2024/5678/XYZ", "", "", "", "", "C/2020/1"]
    values = ["10/01/2025", "10.01.2025", "2025-01-10", "30/02/2024", "No end date", None, "1/2/2024"]
    got = column(spark, values, lambda c: F.date_format(I.parse_date(c), "yyyy-MM-dd"))
    assert got == ["2025-01-10"] * 3 + [None, None, None, "2024-02-01"]
    hrefs = ["/x?uri=OJ:L_1&a=uri=OJ:L_202401015&b", "/none", "../legal-content/EN/?uri=OJ:L_5"]
    assert column(spark, hrefs, I.uri_document_id) == ["202401015", None, "5"]
    assert column(spark, ["/a", "http://x/y", "//z", "b"], lambda c: I.absolute_url("https://e.org", c)) == [
        "https://e.org/a", "http://x/y", "https://z", "https://e.org/b"]


def test_metadata_rules(spark):
    df = spark.createDataFrame(
        [(("32023R2105", "T", "A/2023/1"),), (("x", None, "q"),), ((None, "", None),)],
        "metadata struct<celex_number:string,title:string,identifier:string>")
    assert [r.errors for r in V.validate(df).collect()] == [[], ["title"], ["celex_number", "title"]]


def test_shares_and_targets(spark):
    assert column(spark, [1, 2, 5, 6, 10], M.chunk_share, "int") == [0.34, 0.30, 0.165, 0.125, 0.125]
    assert column(spark, [600, 1000, 1500, 2000, 2500], M.extraction_budget, "long") == [300, 300, 450, 600, 600]
    values = [150, 300, 600, 1000, 2501, 20001]
    assert column(spark, values, M.summary_low, "long") == [15, 50, 100, 180, 480, 600]
    assert column(spark, values, M.summary_high, "long") == [50, 100, 200, 240, 600, 800]
    assert column(spark, [600, 601, 2500, 2501, 20001], M.tier, "long") == [1, 2, 2, 3, 4]
    assert column(spark, [68000, 68001], lambda c: M.supported_tier(c), "long") == [4, None]
    want = [n if n <= 100 else max(100, min(n // max(1, n // 400), 400)) for n in (50, 100, 101, 799, 800, 12345)]
    assert column(spark, [50, 100, 101, 799, 800, 12345], M.balanced_chunk_size, "long") == want


def test_percentiles_match_numpy(spark):
    rng = random.Random(7)
    groups = {"a": [rng.randrange(10**6) for _ in range(501)], "b": [5], "c": [3] * 400 + [9000], None: [1, 2, 3, 4]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v long")
    probs = (0.0, 0.25, 0.5, 0.9, 0.95, 1.0)
    got = {r[0]: r[1:] for r in Q.percentiles(Q.value_counts(df, ["g"], "v"), ["g"], "v", probs).collect()}
    for g, vs in groups.items():
        assert all(math.isclose(a, np.percentile(vs, p * 100)) for a, p in zip(got[g], probs)), g


def test_metric_lines(spark):
    lines = ["# HELP x y", 'x_documents_processed_total{date="2024-01-05",status="success"} 13.0',
             "x_storage_size_bytes 356735.0", "x_storage_size_bytes 1.2e+06", "noise"]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    name, value = X.parse_line(F.col("v"))
    assert [tuple(r) for r in df.select(name, value).collect()] == [
        (None, None), ("x_documents_processed_total", 13.0), ("x_storage_size_bytes", 356735.0),
        ("x_storage_size_bytes", 1.2), (None, None)]
    files = spark.createDataFrame([("metrics_20240105_101112.prom", "\n".join(lines)), ("odd", "")], "name string, text string")
    got = {r.name: r for r in X.sessions(files).collect()}
    s = got["metrics_20240105_101112.prom"]
    assert (s.documents_processed_total, s.storage_size_bytes, s.requests_total) == (13.0, 1.2, 0.0)
    assert str(s.timestamp) == "2024-01-05 10:11:12" and str(got["odd"].timestamp) == "1970-01-01 00:00:00"


def test_character_references(spark):
    cases = {"caf&eacute; &#8211; x&#160;y": "café – x y", "&amp;lt; &lt;b&gt;": "&lt; <b>", "&#x1F600;&#X41;": "😀A", "&bogus; & &; &#0; &#55296; &#99999999;":
             "&bogus; & &; &#0; &#55296; &#99999999;", "plain": "plain", "": "", "&": "&", "a&b;c&apos;": "a&b;c'"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, e string")
    assert [r.d for r in df.select(T.decode_entities(F.col("t")).alias("d"), "e").collect()] == list(cases.values())


def test_timestamps_in_many_shapes(spark):
    cases = {"2024-01-05": "2024-01-05 00:00:00", "2024-1-5 7:08": "2024-01-05 07:08:00", "2024-01-05T07:08:09": "2024-01-05 07:08:09", "2024-02": "2024-02-01 00:00:00",
             "20240105": "2024-01-05 00:00:00", "01/05/2024": "2024-01-05 00:00:00", "25/12/2024": "2024-12-25 00:00:00", "05.01.2024": "2024-01-05 00:00:00",
             "5 january 2024": "2024-01-05 00:00:00", "JAN 5, 2024 23:59": "2024-01-05 23:59:00", "5 May 2024": "2024-05-05 00:00:00", "May 5 2024": "2024-05-05 00:00:00",
             " 2024/12/31 ": "2024-12-31 00:00:00", "31/02/2024": None, "30 Foo 2024": None, "2024-13-01": None, "No end date": None, "": None, "2024-01-05 25:00": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.m for r in df.select("t", F.date_format(I.coerced_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("m")).collect()}
    assert got == cases


def test_texts_become_objects_a_slice_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from docloom.functions import arrays as A
    from docloom.operators import legal_sections as G

    monkeypatch.setattr(A, "SLICE", 300)
    texts = pa.array(["a" * (i % 90) for i in range(50)] + [None, "b" * 1000, ""])
    parts = list(A.text_slices(texts))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) == 1 or sum(len(t or "") + A.OBJECT for t in p.to_pylist()) <= 300 for p in parts) and len(parts) > 10
    assert list(A.text_slices(texts.slice(0, 0))) == []
    seen = []
    monkeypatch.setattr(A.F, "arrow_udf", lambda fn, kind: fn)
    count = A.of_each(lambda s: seen.append(len(s)) or s.str.len(), "long")
    assert count(pa.array([["a" * 200, "b"] * 5, [], None, ["c"]])).to_pylist() == [[200, 1] * 5, [], [], [1]]
    assert len(seen) > 1 and sum(seen) == 11
    assert G.text_slices is A.text_slices

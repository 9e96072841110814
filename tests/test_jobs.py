"""Copies, stores, pairs, pages and streams on small fixtures, hot keys included."""

import itertools
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

import pytest
from docloom.operators import dedup as D
from docloom.operators import legal_sections as G
from docloom.operators import lengths as L
from docloom.operators import pages as P
from docloom.operators import star as S
from docloom.session import shared_dir
from docloom.sources import documents as store
from docloom.sources import export


def test_keep_earliest(spark):
    rows = [("K1", "d/20240105/a.json"), ("K1", "d/20240102/b.json"), ("K2", "d/20240105/c.json"), ("K2", "d/misc/d.json"),
            ("K3", "d/x/e.json"), ("K3", "d/y/f.json"), ("K4", "d/20240101/g.json"), ("K4", "d/20240101/h.json")]
    hot = [("HOT", f"d/202402{i % 28 + 1:02d}/{i}.json") for i in range(500)]
    df = spark.createDataFrame(rows + hot, "celex_number string, path string")
    got = {r.path[-6]: r.status for r in D.keep_earliest(df, "celex_number").filter("celex_number <> 'HOT'").collect()}
    assert got == {"a": "duplicate", "b": "keep", "c": "keep", "d": "unparsed", "e": "unparsed", "f": "unparsed",
                   "g": "keep", "h": "duplicate"}
    kept = D.keep_earliest(df, "celex_number").filter("celex_number = 'HOT' and status = 'keep'").collect()
    assert [r.path for r in kept] == ["d/20240201/0.json"]


def test_store_upsert_lookup_and_bad_files(spark, tmp_path):
    path = str(tmp_path / "store")
    meta = "struct<celex_number:string,title:string>"
    full = store.STORED["metadata"].dataType

    def docs(rows):
        df = spark.createDataFrame(rows, f"doc_id string, m {meta}, content string, day string")
        known = {"celex_number": F.col("m.celex_number"), "title": F.col("m.title")}
        fields = [known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in full.fields]
        day = F.to_date("day")
        return store.with_partitions(
            df.select("doc_id", F.struct(*fields).alias("metadata"), "content", "day"), day, F.date_format("day", "yyyyMMdd"))

    store.store(docs([("1", ("c1", "t"), "old", "2024-01-05"), ("2", ("c2", "t"), "two", "2024-01-05"), ("3", ("c3", "t"), "three", "2023-12-01")]), path)
    store.store(docs([("1", ("c1", "t"), "new", "2024-01-05")]), path)
    bad = tmp_path / "store" / "year=2024" / "bad.json"
    bad.write_text('{"metadata": {"celex_number": ')
    (tmp_path / "store" / "year=2024" / "keyless.json").write_text('{"metadata": {"title": "x"}}\n')
    got = {r.metadata.celex_number: r.content for r in store.scan_tree(spark, path).collect()}
    assert got == {"c1": "new", "c2": "two", "c3": "three"}
    bad.unlink()
    (tmp_path / "store" / "year=2024" / "keyless.json").unlink()
    assert [r.content for r in store.lookup(spark, path, "2024", "01", "20240105", "1").collect()] == ["new"]
    assert store.lookup(spark, path, "2024", "01", "20240105", "9").count() == 0


def test_a_plain_tree_is_read_whole(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    line = '{"metadata": {"celex_number": "%s"}, "content": "x"}\n'
    (tmp_path / "a" / "1.json").write_text(line % "k1" + '{"metadata": {"celex_number": ')
    (tmp_path / "a" / "b" / "2.json").write_text(line % "k2" + '{"metadata": {"title": "x"}}\n')
    assert {r.metadata.celex_number for r in store.scan_tree(spark, str(tmp_path)).collect()} == {"k1", "k2"}


def test_single_document_files(spark, tmp_path):
    (tmp_path / "2024" / "20240105").mkdir(parents=True)
    (tmp_path / "2024" / "20240105" / "a.json").write_text('{\n "metadata": {"celex_number": "c1", "dates": {"Date of effect": "x"}},\n "content": "t"\n}')
    (tmp_path / "2024" / "b.json").write_text("{ not json")
    rows = store.scan_single_files(spark, str(tmp_path)).collect()
    assert [r.metadata.celex_number for r in rows] == ["c1"]
    assert rows[0].path.endswith("20240105/a.json")


def test_export(spark, tmp_path):
    out = str(tmp_path / "report")
    export.export_csv(spark.createDataFrame([(1, "a")], "x int, y string"), out, single_file=True)
    assert spark.read.option("header", True).csv(out).collect()[0].y == "a"


def test_pairs_with_a_hot_document(spark):
    docs = {0: range(40), 1: (1, 2), 2: (1, 2, 3), 3: (5,)}
    want = Counter(p for ms in docs.values() for p in itertools.combinations(sorted(ms), 2))
    links = spark.createDataFrame([(d, m) for d, ms in docs.items() for m in ms], "doc long, member long")
    old, S.BLOCK = S.BLOCK, 8
    try:
        got = {(r.member1, r.member2): r.pair_count for r in S.pair_counts(links, "doc", "member").collect()}
        assert got == dict(want)
        top = [(r.member1, r.member2, r.pair_count) for r in S.top_pairs(links, "doc", "member", 5, seeds=4).collect()]
        assert top == sorted(((*p, n) for p, n in want.items()), key=lambda x: (-x[2], x[0], x[1]))[:5]
    finally:
        S.BLOCK = old


def test_ordinals_across_buckets(spark):
    df = spark.createDataFrame([(1, i * 700) for i in range(9)] + [(2, 5)], "d long, o long")
    got = sorted((r.d, r.o, r.ordinal) for r in S.with_ordinal(df, "d", "o").collect())
    assert got == [(1, i * 700, i) for i in range(9)] + [(2, 5, 0)]


def test_histogram_and_density_of_degenerate_data(spark):
    same = spark.createDataFrame([(7,)] * 5, "chars long")
    h = {r.bin: r.n_docs for r in L.histogram(same, "chars").collect()}
    assert sum(h.values()) == 5 and len(h) == 50
    assert L.density_peaks(L.kernel_density(same)).count() == 0


PAGE = """<html><head><script>var x = "<p class='oj-normal'>no</p>";</script></head><body>
<p class="oj-hd-lg">EN</p><div class="eli-container">
<div class="eli-main-title"><p>REGULATION</p><p>of today</p></div>
<div class="eli-preamble"><p>Having regard</p></div>
<div class="oj-enumeration-spacing"><p style="display: inline;">(a)</p><p style="display: inline;">first item</p></div>
<p class="oj-ti-section">Section one</p>
<p class="oj-ti-art">Article 1</p>
<p class="oj-normal">Body of <i>one</i>.</p><p class="oj-normal">Body of <i>one</i>.</p>
<table><col width="4%"/><col width="96%"/><tr><td><p>1.</p></td><td><p>Numbered<a class="oj-note-tag">(2)</a> text</p></td></tr></table>
<p class="oj-note">a footnote</p>
<p class="oj-ti-art">Article 2</p>
<div><p>See http://x.y/z here</p><table><tr><td>cell</td><td>42</td><td>other</td></tr><tr><td>lonely</td></tr></table></div>
<p>AR mark</p><p>AR again with words</p><p>plain tail</p>
<p class="oj-doc-ti oj-ti-chapter">ANNEX II</p><p>annex body</p>
<div class="eli-subdivision"><p class="oj-normal">Recital text</p><span>span text</span><table><tr><td><p class="oj-normal">Kept cell</p></td></tr></table></div>
<div class="oj-signatory"><p>Signed by</p></div>
</div></body></html>"""


def test_class_marked_page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<html><body><p>no marks</p></body></html>")], "id long, html string")
    rows = [(r.section_type, r.title, r.content) for r in G.sections(df, "id", "html").orderBy("section_order").collect()]
    assert rows == [
        ("header", "Document Title", "REGULATIONof today"),
        ("preamble", "Preamble", "Having regard"),
        ("main", "Main Content", "first item\nRecital text\nKept cell\nspan text\nBody of one.\nBody of one."),
        ("oj-ti-art", "Article 1", "Body of\none\n1. Numbered text"),
        ("oj-ti-art", "Article 2", "See here\ncell\nother\nlonely\nAR mark\nplain tail"),
    ]


INDEX = """<div id="MainContent"><div><p>Intro <a href="/legal-content/EN/TXT/?uri=OJ:L_202401015">A <b>law</b></a></p>
<p>Titled nearby <a href="/legal-content/EN/TXT/?uri=OJ:L_202401016"></a></p>
<a href="/legal-content/EN/TXT/?uri=OJ:L_202490015">correction</a><a href="/about">x</a></div></div>
<a href="/legal-content/EN/TXT/?uri=OJ:L_202401017">outside</a>"""


def test_index_page(spark):
    df = spark.createDataFrame([(1, INDEX), (2, "<p>nothing</p>")], "id long, html string")
    got = [(r.document_id, r.title, r.url) for r in P.links(df, "html", "id", "https://e.org").orderBy("link_no").collect()]
    assert got == [
        ("202401015", "A law", "https://e.org/legal-content/EN/TXT/?uri=OJ:L_202401015"),
        ("202401016", "Titled nearby", "https://e.org/legal-content/EN/TXT/?uri=OJ:L_202401016")]


def test_text_page(spark):
    html = """<div id="TexteOnly"><p>One <b>two</b></p><div class="navigation">menu<p>inner</p></div>
<table><tr><td>c1</td><td>c2 &amp; c3</td></tr></table><!-- <p>no</p> --></div><p>after</p>"""
    df = spark.createDataFrame([(1, html), (2, "<p>x</p>")], "id long, html string")
    got = {r.id: (r.status, r.full_text) for r in P.page_text(df, "html").collect()}
    assert got == {1: ("ok", "Onetwo\ninner\nc1\nc2 & c3"), 2: ("no container", None)}


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two
    if base:
        assert one.startswith(base.rstrip("/") + "/x-")


def test_ingest_keeps_one_copy_per_key_over_restarts(spark, tmp_path):
    from docloom.streaming.ingest import ingest

    src, table, ck = (str(tmp_path / n) for n in ("src", "table", "ck"))
    (tmp_path / "src" / "a").mkdir(parents=True)
    line = '{"metadata": {"celex_number": "%s", "title": "t"}, "content": "%s"}\n'
    (tmp_path / "src" / "a" / "1.json").write_text(line % ("k1", "x") + line % ("k1", "x") + line % ("k2", "y") + '{"content": "no key"}\n')
    assert sorted(r.celex_number for r in ingest(spark, src, table, ck).collect()) == ["k1", "k2"]
    (tmp_path / "src" / "a" / "2.json").write_text(line % ("k2", "z") + (line % ("k3", "hot")) * 200)
    got = sorted((r.celex_number, r.content) for r in ingest(spark, src, table, ck).collect())
    assert got == [("k1", "x"), ("k2", "y"), ("k3", "hot")]
    # A checkpoint lost together with its memory of files adds nothing either.
    again = ingest(spark, src, table, str(tmp_path / "ck2"))
    assert again.count() == 3


def test_scores_with_a_hot_token(spark):
    import math

    from docloom.operators.extraction import tfidf_scores

    texts = [(i, f"the the word{i}. the only!") for i in range(60)]
    df = spark.createDataFrame(texts, "id long, text string")
    idf = lambda d: math.log((60 + 1) / (d + 1)) + 1
    got = {(r.id, r.pos): r.score for r in tfidf_scores(df, "id").collect()}
    assert len(got) == 120
    assert math.isclose(got[(7, 0)], math.hypot(2 * idf(60), idf(1)))
    assert math.isclose(got[(7, 1)], math.hypot(idf(60), idf(60)))


@pytest.mark.parametrize("most", [1 << 18, 3, 0])
def test_scores_from_common_and_joined_tokens(spark, monkeypatch, most):
    """Same scores wherever a token's weight comes from, small slices included; the text is cut once."""
    import math
    import random
    from collections import Counter

    from docloom.operators import extraction as E

    monkeypatch.setattr(E, "TOKEN_SLICE", 7)
    rng = random.Random(1)
    sentences = {i: [" ".join(rng.choice("abcdefé") * rng.randint(1, 2) for _ in range(rng.randint(1, 9))) + "." for _ in range(rng.randint(1, 6))] for i in range(40)}
    sentences[50], sentences[51] = ["?!", "a A a."], []
    rows = [(i, " ".join(s)) for i, s in sentences.items()] + [(52, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    words = lambda s: s.lower().strip(".?!").split()
    seen = Counter(w for s in sentences.values() for w in {w for x in s for w in words(x)})
    n = len(rows)
    want = {(i, k): math.sqrt(sum((c * (math.log((n + 1) / (seen[w] + 1)) + 1)) ** 2 for w, c in Counter(words(x)).items()))
            for i, s in sentences.items() for k, x in enumerate(s)}
    cut = df.select("id", F.split(F.lit("a. zz zz."), " ").alias("s")).limit(1)
    found = E.by_tfidf(df, most=most)(cut, ["id"], "s", "x").first().x
    assert math.isclose(found[0], math.log((n + 1) / (seen["a"] + 1)) + 1, rel_tol=1e-6) and len(found) == 3
    monkeypatch.setattr(E.by_tfidf, "__defaults__", ("text", 9, most))
    out = E.tfidf_scores(df, "id")
    assert "regexp_extract_all" not in out._jdf.queryExecution().toString()
    got = {(r.id, r.pos): r.score for r in out.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_snapshots_of_one_name_in_two_folders_stay_apart(spark, tmp_path):
    from docloom.operators import metrics as X
    from docloom.sources import snapshots as S

    for folder, name, n in (("a", "metrics_20240101_000000.prom", 3), ("b", "metrics_20240101_000000.prom", 5), ("b", "odd.txt", 7)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(f"corpus_documents_processed_total {n}.0\n")
    rows = X.sessions(S.read_snapshots(spark, str(tmp_path))).collect()
    assert sorted((r["name"], r.documents_processed_total) for r in rows) == [
        ("metrics_20240101_000000", 3.0), ("metrics_20240101_000000", 5.0), ("odd.txt", 7.0)]


def test_reserved_characters_survive_chunking(spark):
    from docloom.operators import chunking as C

    text = " start " + "word " * 30 + "\nArticle 1. one0 " + "text " * 30
    df = spark.createDataFrame([(text,)], "t string")
    chunks = df.select(C.structure_chunks(F.col("t"), 40).alias("c")).first().c
    assert " ".join(chunks).split() == text.split() and len(chunks) == 2


def test_ingest_lists_only_the_folders_of_a_batch(spark, tmp_path):
    from docloom.streaming import ingest as I

    target = str(tmp_path / "table")
    batch = lambda keys: spark.createDataFrame([(k, "t", "c", "f") for k in keys], I.TABLE)
    write = I.append_unseen(target, 16)
    write(batch([f"k{i}" for i in range(200)]), 0)
    folders = lambda keys: {r.b for r in batch(keys).select(I.bucket_of(F.col("celex_number"), 16).alias("b")).collect()}
    some = folders(["k1", "k2", "new"])
    listed = {int(f.rsplit("bucket=", 1)[1].split("/")[0]) for f in I.stored_keys(spark, target, sorted(some)).inputFiles()}
    assert len(some) < 16 and listed == some
    assert I.stored_keys(spark, str(tmp_path / "none"), [1]) is None
    before = {str(f) for f in (tmp_path / "table").rglob("*.parquet")}
    write(batch(["k1", "k2", "new", "new"]), 1)
    write(batch(["k1", "k2", "new", "new"]), 1)  # run again
    added = {str(f) for f in (tmp_path / "table").rglob("*.parquet")} - before
    assert {int(f.rsplit("bucket=", 1)[1].split("/")[0]) for f in added} == folders(["new"])
    assert spark.read.parquet(target).count() == 201


def test_counters_write_what_changed_and_keep_one_base(spark, tmp_path):
    from docloom.streaming.counters import CounterTable

    schema = spark.createDataFrame([], "label string, value long").schema
    table = CounterTable(spark, str(tmp_path / "t"), ["label"], schema)
    batch = lambda rows: spark.createDataFrame(rows, schema)
    want = {}
    for k, rows in enumerate([[(f"l{i}", 1) for i in range(50)], [("l1", 2)], [("l1", 3), (None, 1)], [(f"l{i}", 9) for i in range(49)], [("l2", 10)]]):
        for _ in range(2):  # every batch is run again
            table.write(batch(rows), k)
        want.update(rows)
        assert {r.label: r.value for r in table.table().collect()} == want
        side, merged = table.current()
        assert table.changes(side, merged).count() <= table.base(side).count()
        if k in (1, 2):
            assert spark.read.parquet(f"{table.path}/version-{side}/changes/batch={k}").count() == len(rows)
    assert table.base(1 - side).count() == 0
    # A merge that dies before it points to its version changes nothing.
    real = table.table().collect()
    table.table().limit(1).write.mode("overwrite").parquet(f"{table.path}/version-{1 - side}/base")
    assert sorted(map(str, table.table().collect())) == sorted(map(str, real))


def test_an_upsert_that_dies_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    from docloom.sources import documents as store

    path = str(tmp_path / "store")
    schema = store.STORED
    def docs(rows):
        df = spark.createDataFrame([(d, {"celex_number": d, "title": "t"}, c) for d, c, _ in rows], schema)
        days = spark.createDataFrame([(d, day) for d, _, day in rows], "doc_id string, day string")
        return store.with_partitions(df.join(days, "doc_id"), F.to_date("day"), F.concat("day", F.lit(" a/b [c]=%")))
    found = lambda: {r.metadata.celex_number: r.content for r in store.scan_tree(spark, path).collect()}
    store.store(docs([("a", "one", "2024-01-05"), ("b", "two", "2024-01-05"), ("c", "three", "2023-12-01"), ("d", "no day", None)]), path)
    assert found() == {"a": "one", "b": "two", "c": "three", "d": "no day"}
    with monkeypatch.context() as m:
        m.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.store(docs([("a", "new", "2024-01-05"), ("e", "more", "2024-01-06")]), path)
    assert found() == {"a": "one", "b": "two", "c": "three", "d": "no day"}
    store.store(docs([("a", "new", "2024-01-05"), ("d", "still no day", None), ("f", "f", None)]), path)
    assert found() == {"a": "new", "b": "two", "c": "three", "d": "still no day", "f": "f"}
    # What an upsert does not touch is neither read nor written.
    commits = {p: c for p, c in store._entries(spark, path)[1].items()}
    assert len(set(commits.values())) == 2 and len(commits) == 3
    files = store._partitioned(spark, path, {p: c for p, c in commits.items() if p[0] == "2023"}).inputFiles()
    assert files and all("year=2023" in f for f in files)


def test_keys_of_the_star_schema_cannot_collide(spark, monkeypatch):
    from docloom import schemas

    monkeypatch.setattr(S.F, "xxhash64", lambda *c: F.lit(7))
    def record(celex, authors, form, content="x"):
        meta = {"celex_number": celex, "authors": authors, "form": form, "dates": {"Date of document": "05/01/2024"}, "directory_codes": ["01", "02"],
                "directory_descriptions": ["a", "b"]}
        return meta, content
    rows = [record(f"c{i}", [f"n{i % 7}", f"n{i % 7}", "all", "", None], ("F", "G", "", None)[i % 4]) for i in range(40)]
    rows += [record("c1", ["other"], "Z", "changed"), record("c1", ["other"], "Z", "changed"), record(None, ["lost"], "L"), record("c2", None, "F")]
    t = S.star_schema(spark.createDataFrame(rows, schemas.DOCUMENT).repartition(6))
    assert set(t) == set(S.TABLES)
    for name, key, n in (("documents", "document_id", 40), ("authors", "author_id", None), ("forms", "form_id", None), ("directory_codes", "directory_id", 2)):
        ids = sorted(r[key] for r in t[name].select(key).collect())
        assert ids == list(range(1, len(ids) + 1)) and n in (None, len(ids))
    assert sorted(r.celex_number for r in t["documents"].collect()) == sorted(f"c{i}" for i in range(40))
    names = {r.author_id: r.name for r in t["authors"].collect()}
    assert [names[k] for k in sorted(names)] == sorted(names.values()) and "lost" not in names.values()  # numbered in order of the names
    docs = {r.document_id: r.celex_number for r in t["documents"].collect()}
    links = sorted((docs[r.document_id], names[r.author_id]) for r in t["document_authors"].collect())
    assert ("c5", "n5") in links and ("c5", "all") in links and len(links) == len(set(links))
    forms = {r.form_id: r.form_name for r in t["forms"].collect()}
    assert all(forms.get(r.form_id) == ("F", "G", None, None)[int(r.celex_number[1:]) % 4] for r in t["documents"].collect() if r.celex_number not in ("c1", "c2"))
    assert set(S.star_schema(spark.createDataFrame([], schemas.DOCUMENT), ("documents", "authors"))["documents"].collect()) == set()


def test_sketched_percentiles_of_a_large_and_a_small_group(spark):
    from docloom.operators import quantiles as Q

    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 2).cast("string"))).alias("g"),
                                   (F.col("id") % 5).alias("part"), (F.col("id") * 7919 % 10007).alias("v"))
    df = df.union(spark.createDataFrame([("one", 0, 42)], "g string, part long, v long"))
    merged = Q.merged(Q.sketches(df, ["g", "part"], "v"), ["g"])
    got = Q.rank_errors(Q.approximate_percentiles(merged, ["g"], (0.0, 0.5, 0.99, 1.0)), Q.value_counts(df, ["g"], "v"), ["g"], "v").collect()
    assert len(got) == 16 and sum(r.n for r in got) == 4 * 20001
    assert all(0 <= r.rank_error <= Q.RANK_ERROR for r in got)
    assert {r.estimate for r in got if r.g == "one"} == {42}


def test_most_frequent_keys_with_collisions_and_without(spark, monkeypatch):
    from docloom.operators import heavy as H

    rows = [(f"k{i}", i % 2) for i in range(300) for _ in range(1 + (i * 7) % 23)] + [(None, 1)] * 30
    df = spark.createDataFrame(rows, "key string, odd int").repartition(5)
    want = sorted(Counter(k for k, _ in rows if k).items(), key=lambda x: (-x[1], x[0]))
    for buckets, seeds in ((1 << 20, 1024), (64, 3), (1, 1), (5, 1)):
        monkeypatch.setattr(H, "BUCKETS", buckets)
        got = H.most_frequent(df, ["key"], 8, sums=["odd"], seeds=seeds).collect()
        assert got[0].key is None and got[0].n == got[0].odd == 30
        assert [(r.key, r.n) for r in got[1:]] == want[:7]
        odd = H.most_frequent(df, ["key"], 5, sums=["odd"], keep=F.col("odd") >= 1, seeds=seeds).collect()
        assert [(r.key, r.n) for r in odd[1:]] == [(k, n) for k, n in want if int(k[1:]) % 2][:4]
    assert H.most_frequent(df.limit(0), ["key"], 3).count() == 0


def test_pairs_of_flat_degrees_are_not_counted_one_by_one(spark, monkeypatch):
    from docloom.operators import heavy as H

    monkeypatch.setattr(H, "BUCKETS", 4096)
    docs = [[(7 * d + 13 * j * (d % 11 + 1)) % 997 for j in range(5)] for d in range(3000)] + [[1, 2, 3]] * 40
    links = spark.createDataFrame([(d, m) for d, ms in enumerate(docs) for m in set(ms)], "doc long, member long")
    want = Counter(p for ms in docs for p in itertools.combinations(sorted(set(ms)), 2))
    pairs = S.pairs_of(links, "doc", "member")
    assert pairs.count() == sum(want.values())
    left = H.reaching(pairs, ["member1", "member2"], 3).distinct().count()
    assert 3 <= left < len(want) / 50
    top = [(r.member1, r.member2, r.pair_count) for r in S.top_pairs(links, "doc", "member", 3).collect()]
    assert top == sorted(((*p, n) for p, n in want.items()), key=lambda x: (-x[2], x[0], x[1]))[:3]


def test_single_files_share_one_folder(spark, tmp_path):
    from docloom.sources import documents as store

    path = str(tmp_path / "files")
    docs = spark.createDataFrame([(i % 40, {"celex_number": f"c{i % 40}", "title": "t"}, f"text {i % 40}") for i in range(80)],
                                 "file long, metadata struct<celex_number string, title string>, content string")
    store.write_single_files(docs, "file", path)
    files = [f for f in (tmp_path / "files").rglob("*.json")]
    assert len(files) == 40 and {f.parent for f in files} == {tmp_path / "files"}
    rows = store.scan_single_files(spark, path).collect()
    assert sorted((r.metadata.celex_number, r.content) for r in rows) == sorted((f"c{i}", f"text {i}") for i in range(40))


def test_a_batch_shuffles_its_texts_once(spark, tmp_path, monkeypatch):
    """The copies of a batch are told apart by narrow rows; texts are dealt once, to their folders. Titles and null contents go with their row."""
    from docloom.streaming import ingest as I

    plans, made = [], I.materialise
    monkeypatch.setattr(I, "materialise", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or made(df, name))
    write = I.append_unseen(str(tmp_path / "t"), 4)
    schema = "celex_number string, title string, content string, file string"
    rows = [("a", "second", "x", "f2"), ("a", "first", "y", "f1"), ("b", "only", None, "f1"), ("c", "twice", "z", "f1"), ("c", "twice", "z", "f1")]
    write(spark.createDataFrame(rows, schema).repartition(3), 0)
    write(spark.createDataFrame([("a", "late", "w", "f0"), ("d", "new", "v", "f3")], schema).repartition(2), 1)
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(f"{tmp_path}/t/bucket=*").collect())
    assert got == [("a", "first", "y", "f1"), ("b", "only", None, "f1"), ("c", "twice", "z", "f1"), ("d", "new", "v", "f3")]
    narrow = [p for n, p in plans if n == "first-copies"]
    assert len(narrow) == 2 and all("title" not in p for p in narrow)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams_without_a_slice_for_each_place(spark, n):
    from docloom import constants as K
    from docloom.operators import ngrams as N

    texts = [(1, "red fox red fox red fox"), (2, "fox the red"), (3, "fox"), (4, ""), (5, None), (6, "red fox")]
    out = N.ngrams(spark.createDataFrame(texts, "id long, text string"), n)
    assert "array_join" not in out._jdf.queryExecution().toString()
    want = Counter()
    for _, t in texts:
        w = [x for x in (t or "").split() if x not in K.STOP_WORDS]
        for g, c in Counter(" ".join(w[i:i + n]) for i in range(len(w) - n + 1)).items():
            want[g, 1] += 1
            want[g, 0] += c - 1
    assert Counter((r.ngram, r.first) for r in out.collect()) == +want


def test_ingest_writes_outcomes_without_a_sort(spark, tmp_path):
    from docloom.operators import ingest as J

    def page(key, title, eli=True):
        link = '<a href="http://data.europa.eu/eli/1">' if eli else ""
        return f'<p class="DocumentTitle">Document {key}</p><div><p id="title">{title}</p></div>{link}<dl><dt>Author</dt><dd>A, B</dd></dl>'
    text = lambda t: f'<div id="text"><p>{t}</p></div>'
    rows = [("1", page("k1", "one"), text("x")), ("2", page("k1", "one"), text("y")), ("3", page("k2", "two"), text("z")), ("4", page("k3", "lost", False), text("t")),
            ("5", page("k4", "seen"), text("t")), ("6", page("k5", "no text"), "<p>t</p>"), ("7", None, text("t")), ("8", page("k2", "two"), None), ("9", page("k1", "one"), text(""))]
    pages = spark.createDataFrame([(*r, "2024-01-05") for r in rows], "doc_id string, meta_html string, text_html string, day string")
    seen = spark.createDataFrame([("k4",), ("k4",), (None,)], "celex_number string")
    done = J.ingest(pages, seen, str(tmp_path / "s"), "https://e.org", F.to_date("day"), F.lit("j"))
    want = {"1": J.SUCCESS, "2": J.SUCCESS, "3": J.SUCCESS, "4": "metadata failed", "5": "already stored", "6": "text failed", "7": "metadata failed", "8": "text failed", "9": J.SUCCESS}
    got = done.outcomes.collect()
    assert {r.doc_id: r.status for r in got} == want and len(got) == len(want)
    assert all((r.metadata is None) == (r.content is None) == (r.status != J.SUCCESS) and r.n_chars == len(r.content or "") for r in got)
    assert done.counts == {s: list(want.values()).count(s) for s in J.OUTCOMES}
    stored = store.scan_tree(spark, done.path).collect()
    assert sorted(r.doc_id for r in stored) == ["k1", "k2"]
    assert {(r.metadata.title, r.content) for r in stored} & {("one", "x"), ("one", "y"), ("one", "")} and ("two", "z") in {(r.metadata.title, r.content) for r in stored}
    # Folders by outcome take a sort of all records.
    assert not any("status=" in f for f in done.outcomes.inputFiles())


def test_written_rows_are_put_together_by_key_only_where_keys_repeat(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FEW", 0.1)
    def written(name, keys):
        df = spark.createDataFrame([(k, {"celex_number": k, "title": f"t{i}"}, f"c{i}", day) for i, (k, day) in enumerate(keys)], T.StructType([*store.STORED, T.StructField("day", T.StringType())]))
        store.with_partitions(df, F.to_date("day"), F.col("day")).drop("day").write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))
    once = [(f"k{i}", f"2024-01-0{i % 3 + 1}") for i in range(30)]
    few = [*once, ("k1", "2024-01-02"), ("k1", "2024-01-01"), (None, "2024-01-01"), (None, None)]
    many = [*once, *once, (None, None), (None, None)]
    for name, keys in (("once", once), ("few", few), ("many", many)):
        docs = written(name, keys)
        rows = docs.select(*store.STORED.fieldNames(), *store.PARTITIONS)
        got = store.one_per_key_of_written(rows)
        key = lambda r: (str(r.doc_id), str(r.journal_id))
        assert sorted(got.collect(), key=key) == sorted(store.one_per_key(rows).collect(), key=key)
        if name == "once":
            assert "Exchange" not in got._jdf.queryExecution().toString()
        store.store(docs, str(tmp_path / f"{name}-store"), written=True)
        store.store(docs, str(tmp_path / f"{name}-as-before"))
        a, b = ([r[:-1] for r in store.scan_tree(spark, str(tmp_path / f"{name}-{x}")).collect()] for x in ("store", "as-before"))
        assert sorted(a, key=str) == sorted(b, key=str) and len(a) == len({k for k in keys if k[0]})
    # An upsert of written rows over stored ones.
    store.store(written("new", [("k1", "2024-01-02"), ("k99", "2024-01-02"), ("k99", "2024-01-02")]), str(tmp_path / "few-store"), written=True)
    stored = store.scan_tree(spark, str(tmp_path / "few-store")).collect()
    assert len(stored) == 32 and {r.content for r in stored if r.doc_id == "k1" and r.metadata.title == "t0"} == {"c0"}

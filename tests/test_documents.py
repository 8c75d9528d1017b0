"""Deduplication, node cleaning, pages, crawl records, shards and streaming."""

import gzip
import io
import json
import random
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.functions.constants import EOD
from folioloom.operators import clean, dedup, filters, images, stats
from folioloom.operators.documents import NODE, from_wire, to_wire
from folioloom.plans import html as H
from folioloom.plans import dom, models, pipeline
from folioloom.sources import crawl

from . import plain_html


def nodes_of(spark, *items):
    """Documents from lists of texts, and of images as ("src",)."""
    rows = [(k, [(None, (x[0],)) if isinstance(x, tuple) else (x, None) for x in doc]) for k, doc in enumerate(items)]
    small = spark.createDataFrame(rows, "id long, nodes array<struct<text:string,meta:struct<src:string>>>")
    full = F.transform("nodes", lambda n: F.struct(n["text"].alias("text"), F.when(n["meta"].isNotNull(), F.from_json(F.to_json(n["meta"]), NODE[len("struct<text:string,meta:") : -1])).alias("meta")).cast(NODE))
    return small.withColumn("nodes", full)


def shown(df):
    return {r.id: [n.text if n.text is not None else n.meta and (n.meta.src,) for n in r.nodes] for r in df.collect()}


def test_merge_and_images_once(spark):
    docs = nodes_of(spark, ["A", "", "B", ("i",), "C"], [("x",), ("y",), ("x",)], [None, None], [])
    merged = docs.withColumn("nodes", clean.merge_texts(F.col("nodes"), NODE))
    assert shown(merged) == {0: ["A\n\nB", ("i",), "C"], 1: [("x",), ("y",), ("x",)], 2: [], 3: []}
    assert shown(merged.withColumn("nodes", clean.merge_texts(F.col("nodes"), NODE))) == shown(merged)
    assert shown(docs.withColumn("nodes", clean.images_once(F.col("nodes"))))[1] == [("x",), ("y",)]


def test_final_processing(spark):
    docs = nodes_of(spark, ["good text here", ("i",), ("i",), f"more\n\n{EOD}\n\n{EOD}", ("j",)], [EOD, ("i",)], ["only text"])
    assert shown(pipeline.finish(docs)) == {0: ["good text here", ("i",), "more", ("j",)]}


def test_latest_keeps_ties_and_sets_keep_one(spark):
    docs = spark.createDataFrame([(1, "u", "a"), (2, "u", "b"), (3, "u", "b"), (4, "v", "a")], "id long, url string, warc string")
    assert sorted(r.id for r in dedup.latest_per_url(docs, "url", "warc").collect()) == [2, 3, 4]
    sets = spark.createDataFrame([(1, "u1", "a", "s"), (2, "u2", "b", "s"), (3, "u3", "a", "t")], "id long, url string, warc string, sig string")
    assert sorted(r.id for r in dedup.set_dedup(sets, "url", "sig", "warc", "id").collect()) == [2, 3]


def test_frequency_threshold_and_null_keys(spark):
    rows = spark.createDataFrame([("a",)] * 11 + [("b",)] * 10 + [(None,)] * 20, "src string")
    frequent = dedup.too_frequent(rows, "src", 10)
    assert [r.src for r in frequent.collect()] == ["a"]
    assert dedup.remove_listed(rows, "src", frequent).count() == 30


def test_line_dedup_removes_all_copies_and_protects_the_sentinel(spark):
    rows = [(k, "d", f"p\n\n{EOD}\n\nown {k}") for k in range(3)] + [(9, "other", "p"), (10, "d", None)]
    docs = spark.createDataFrame(rows, "id long, site string, text string")
    got = {r.id: r.text for r in dedup.line_dedup(docs, ["id"], "site").collect()}
    assert got == {0: f"{EOD}\n\nown 0", 1: f"{EOD}\n\nown 1", 2: f"{EOD}\n\nown 2", 9: "p", 10: ""}


def test_pipeline_steps_on_nodes(spark):
    docs = nodes_of(spark, *[["shared line", ("pic",), f"own {k}"] for k in range(12)]).withColumn("url", F.lit("https://s.example/x"))
    assert shown(pipeline.remove_frequent_images(docs, "id"))[3] == ["shared line", "own 3"]
    assert shown(pipeline.line_dedup(docs, "id"))[3] == ["", ("pic",), "own 3"]


def test_wire_form(spark):
    meta = json.dumps([None, {"src": "http://e.com/a.png", "rendered_width": "50%"}])
    wire = spark.createDataFrame([(1, ["t", None], ["", "x"], meta, json.dumps({"url": "u"}))], "id long, texts array<string>, images array<string>, metadata string, general_metadata string")
    docs = from_wire(wire)
    row = docs.first()
    assert row.nodes[0].text == "t" and row.nodes[0].meta is None and row.nodes[1].meta.src == "http://e.com/a.png" and row.general.url == "u"
    assert to_wire(docs).first().images == [None, "http://e.com/a.png"]


PAGE = (
    "<html><head><title>T</title></head><body><!-- c --><div class='footer'>no</div><div id='menu'>no</div><div class='post-date'>2020<p>kept</p></div>"
    "<p>Hello <b>bold</b> word<br>next</p><p>Second</p><img src='../a/b_c.jpg' width='300px' alt='x'><a class='more-link'>more</a><script>no()</script><table><tr><td>no</td></tr></table></body></html>"
)


def test_html(spark):
    pages = spark.createDataFrame([(1, "https://ex.com/p", PAGE), (2, "https://ex.com/q", None), (3, "https://ex.com/r", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in H.web_documents(pages).collect()}
    texts = [n.text for n in got[1].nodes]
    assert texts == ["kept\n\nHello bold word\nnext\n\nSecond", None, EOD]
    image = got[1].nodes[1].meta
    assert (image.src, image.formatted_filename, image.rendered_width, image.alt_text) == ("https://ex.com/a/b_c.jpg", "b c", "300", "x")
    assert got[2].nodes == [] and got[3].nodes == [] and {r.extract_error for r in got.values()} == {""}


SHORT = {"<div>a </div>b": "a\nb", "<p>a</p><p>b</p>": "a\n\nb", "a<span>b</span>c": "abc", "<ul>x</ul>y": "x\n\ny"}


def test_separators(spark):
    pages = spark.createDataFrame([(k, "http://e.com/p", t) for k, t in enumerate(SHORT)], "id long, url string, html string")
    assert [[n.text for n in r.nodes] for r in H.web_documents(pages).orderBy("id").collect()] == [[t] for t in SHORT.values()]


TAGS = "div p span b a ul li section img video source figure h1 h2 blockquote td table br em html body object audio nav footer time".split()
PIECES = ["text", " ", "\n", "  two  words ", "x\ny", "a<br>b", " lead", "trail ", "\xa0", "<br/>", "&amp;", "tab\there", "", "<br> <br>", "Größe 😀"]
ATTRS = [" class='footer'", " class='more-link'", " class='date x'", " id='nav'", " title='menu'", " src='/a.png'", " src='b,c'", " data-src='http://e.com/q w.jpg'", " width='30px'", " alt='t'", " class='x y'"]


def random_page(rng, depth=5):
    def one(d):
        if not d or rng.random() < 0.35:
            return rng.choice(PIECES)
        tag, attrs = rng.choice(TAGS), "".join(rng.choice(ATTRS) for _ in range(2) if rng.random() < 0.3)
        inside = "".join(one(d - 1) for _ in range(rng.randrange(4)))
        return f"<{tag}{attrs}>" if tag in ("img", "source", "br") else f"<{tag}{attrs}>{inside}</{tag}>"

    return "".join(one(depth) for _ in range(rng.randrange(1, 5)))


SWITCHES = ["", "only_text_and_images", "remove_empty", "unnest", "merge_texts", "unwrap", "remove_dates", "strip_tags", "strip_special_divs", "format_texts", "replace_classes", "remove_classes"]


@pytest.mark.parametrize("off", SWITCHES)
def test_pages_like_plain_trees(spark, off):
    """Each step of simplification and extraction, on and off, on random pages, and all nodes of the simplified trees."""
    default = H.ExtractOptions()
    o = H.ExtractOptions(**({off: False if isinstance(getattr(default, off), bool) else type(getattr(default, off))()} if off else {}))
    rng = random.Random(off)
    pages = spark.createDataFrame([(k, random_page(rng)) for k in range(150)], "id long, html string")
    rows = pages.select("id", H.prepared(F.col("html"), o).alias("html"))
    found = rows.select("id", "html", H.parsed("html").alias("found")).withColumns({
        "nodes": T.let(F.col("found.nodes"), lambda n: dom.extracted(n, o)), "left": T.let(F.col("found.nodes"), lambda n: dom.simplified(n, o)),
    })
    told = lambda attrs: attrs and tuple(attrs.get(k) for k in ("_source", "_media", "alt", "width"))
    for r in found.select("html", "nodes", "left", "found.error").collect():
        assert r.error == ""
        assert [(n.text, told(n.attrs)) for n in r.nodes] == [(n["text"], told(n["attrs"])) for n in plain_html.extract_nodes(r.html, o)], r.html
        want = [(p[-1][0], len(p), x if isinstance(x, str) else None) for p, x in plain_html.preorder(plain_html.simplify(r.html, o))]
        assert [(x.tag, len(x.path), x.text) for x in r.left] == want, r.html


def record(kind, body):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    return head + body + b"\r\n\r\n"


def test_crawl(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n" + "<p>caf\xe9</p>".encode("latin-1")
    first, second = gzip.compress(record("request", b"x") + record("response", http)), b"broken"
    (tmp_path / "w").write_bytes(first + second)
    rows = [("u1", "w", 0, len(first)), ("u2", "w", len(first), len(second)), ("u3", "missing", 0, 5)]
    pointers = spark.createDataFrame(rows, "url string, warc_filename string, warc_record_offset long, warc_record_length long")
    root = str(tmp_path)
    got = {r.url: r for r in crawl.extract_html(pipeline.download(pointers, lambda: crawl.LocalReader(root))).collect()}
    assert got["u1"].html == "<p>café</p>" and got["u1"].html_error == ""
    assert got["u2"].html_error == "Not page or encoding" and got["u3"].html_error == "no WARC"
    rate = stats.success_rate(pointers.withColumn("e", F.when(F.col("url") == "u1", "").otherwise("x")), "e").first()
    assert (rate.n, rate.n_ok) == (3, 1)


def test_image_archives_and_headers(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 300, 200)
    with tarfile.open(tmp_path / "a.tar", "w") as tar:
        for name, data in (("1.jpg", png), ("1.json", b'{"url": "u", "status": "success"}'), ("2.jpg", b"x"), ("2.json", b'{"url": "v", "status": "failed"}'), ("3.jpg", b"z"), ("3.json", b'{"url": "u", "status": "success"}')):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    got = crawl.images_from_tars(spark, f"{tmp_path}/*.tar").collect()
    assert [(r.url, bytes(r.image)) for r in got] == [("u", b"z")]
    rows = spark.createDataFrame([(png,), (b"",), (None,)], "image binary").select(images.probe("image").alias("p")).collect()
    assert tuple(rows[0].p) == ("png", 300, 200) and tuple(rows[1].p) == (None, None, None)


def test_shards(spark):
    rows = stats.with_shards(spark.range(10), ["id"], 3).groupBy("split", "shard").count().orderBy("shard").collect()
    assert [(r.split, r.shard, r["count"]) for r in rows] == [("valid", 0, 3), ("valid", 1, 3), ("train", 2, 2), ("train", 3, 2)]


def test_opt_out_pads_single_calls(spark):
    class Client:
        def opted_out(self, urls):
            assert len(urls) > 1
            return [u.startswith("no") for u in urls]

    urls = spark.createDataFrame([("no1",), ("yes",), ("no2",)], "url string")
    assert sorted(r.url for r in models.opted_out(urls, Client, 2).collect()) == ["no1", "no2"]


def test_streaming_matches_batch(spark, tmp_path):
    from folioloom.streaming import ingest

    pages = spark.createDataFrame([(k, f"https://ex.com/{k}", f"<p>page {k}</p>") for k in range(5)], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/in")
    stream = ingest.pages_stream(spark, f"{tmp_path}/in")
    ingest.write_documents(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert sorted(got.collect()) == sorted(H.web_documents(pages).collect())


def test_node_and_document_filters(spark):
    from folioloom.operators.filters import TextLimits

    meta = lambda w, h, shown=None, kind="png": F.struct(F.lit(f"http://e.com/{w}x{h}").alias("src"), F.lit(w).alias("original_width"), F.lit(h).alias("original_height"), F.lit(shown).cast("string").alias("rendered_width"), F.lit(kind).alias("format"))
    full = lambda m: F.struct(*(m.getField(n).alias(n) if n in ("src", "original_width", "original_height", "rendered_width", "format") else F.lit(None).cast(t).alias(n) for n, t in (x.split(":") for x in NODE.split("meta:struct<")[1].rstrip(">").split(","))))
    text = "one two three four five\n\nno\n\n" + EOD
    node = lambda t, m: F.struct(F.lit(t).cast("string").alias("text"), (full(m) if m is not None else F.lit(None)).alias("meta")).cast(NODE)
    nodes = F.array(node(text, None), node(None, meta(200, 300)), node(None, meta(100, 300)), node(None, meta(400, 401, "50%")), node(None, meta(400, 401, "10%")), node(None, meta(300, 300, None, "gif")), node("x", None), node(None, None))
    docs = spark.range(1).withColumn("nodes", nodes)
    loose = TextLimits(stopwords=None, common=None, flagged=None)
    row = pipeline.filter_documents(docs, loose, TextLimits(least_words=2, stopwords=None, common=None, flagged=None)).first()
    assert [n.text or n.meta.src for n in row.nodes] == [f"one two three four five\n\n{EOD}", "http://e.com/200x300", "http://e.com/400x401"]
    assert pipeline.filter_documents(docs, loose, TextLimits(least_words=50, stopwords=None, common=None, flagged=None)).count() == 0
    before_after = {r.step: (r.n_docs, r.n_images) for r in pipeline.report(docs, pipeline.filter_documents(docs, loose, loose)).collect()}
    assert before_after["before"] == (1, 5) and before_after["after"] == (1, 2)


def test_document_filter_applies_every_limit(spark):
    from folioloom.operators.filters import TextLimits

    image = f"named_struct({', '.join(f"'{n}', cast({dict(src="'s'", original_width='200', original_height='300', format="'png'").get(n, 'null')} as {t})" for n, t in (x.split(':') for x in NODE.split('meta:struct<')[1].rstrip('>').split(',')))})"
    texts = ["once upon a time there lived some people of whom nobody knew much", "the same old words again " * 6, "falsch " + " ".join(f"w{chr(97 + k)}" for k in range(20)), "odd " + " ".join(f"v{chr(97 + k)}" for k in range(20))]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + "\n\n" + texts[1]])), "id int, t string").selectExpr("id", f"cast(array(named_struct('text', t, 'meta', null), named_struct('text', null, 'meta', {image})) as array<{NODE}>) as nodes")
    off = dict(stopwords=None, common=None, flagged=None, punctuation=None, special=None)
    none = TextLimits(char_repetition=None, word_repetition=None, **off)
    ids = lambda nodes, whole, *models: [r.id for r in pipeline.filter_documents(docs, nodes, whole, *models).orderBy("id").collect()]
    assert ids(none, none) == [0, 1, 2, 3, 4]
    assert ids(none, TextLimits(**off)) == [0, 2, 3]
    assert ids(TextLimits(**off), none) == [0, 2, 3, 4]  # of 4 the repetitive paragraph goes
    whole = TextLimits.of_documents(**off)
    assert ids(none, whole, lambda t: ~t.startswith("falsch"), lambda t: F.when(t.startswith("odd"), 2000.0).otherwise(10.0)) == [0]
    for limits in (TextLimits(language=0.8, **off), TextLimits(perplexity=1500, **off)):
        with pytest.raises(ValueError):
            pipeline.filter_documents(docs, none, limits)
        with pytest.raises(ValueError):
            pipeline.filter_documents(docs, limits, none)


def test_full_node_filter_keeps_sentinels_and_documents(spark, tmp_path):
    from folioloom import queries

    spark.createDataFrame([(1, f"x\n{EOD}\nx", "s"), (2, "x", "s")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in queries.node_filter_full(spark, str(tmp_path)).collect()) == [(1, EOD), (2, None)]


def test_crawl_to_documents(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>first</p><img src='/a.png'><p>last</p>"
    (tmp_path / "w").write_bytes(gzip.compress(record("response", http)))
    size = (tmp_path / "w").stat().st_size
    pointers = spark.createDataFrame([("https://ex.com/p", "w", 0, size)], "url string, warc_filename string, warc_record_offset long, warc_record_length long")
    root = str(tmp_path)
    docs = pipeline.extract(pipeline.download(pointers, lambda: crawl.LocalReader(root)))
    row = docs.first()
    assert [n.text or n.meta.src for n in row.nodes] == ["first", "https://ex.com/a.png", "last"] and row.warc_filename == "w"
    crawl.write_image_urls(docs, f"{tmp_path}/urls")
    assert [r.value for r in spark.read.text(f"{tmp_path}/urls").collect()] == ["https://ex.com/a.png"]
    crawl.write_shards(stats.with_shards(docs.select("url"), ["url"], 1), f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").first().split == "valid"


def test_stream_keeps_first_of_a_url(spark, tmp_path):
    from folioloom.streaming import ingest

    rows = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3)], "url string, n int").selectExpr("url", "timestamp_seconds(n) as fetched")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = ingest.first_per_url(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    query = stream.writeStream.format("memory").queryName("firsts").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.url for r in spark.table("firsts").collect()) == ["u", "v"]


def test_line_dedup_keeps_null_keys_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "s", "x\n\ny"), (1, "s", "x\n\ny"), (None, "s", "x\n\nz"), (2, "s", None), (None, None, "x"), (3, "s", "")], "id long, site string, text string")
    got = sorted(map(repr, dedup.line_dedup(docs, ["id"], "site").select("id", "text").toLocalIterator()))
    assert got == sorted(map(repr, spark.createDataFrame([(1, "y"), (1, "y"), (None, "z"), (2, ""), (None, "x"), (3, "")], "id long, text string").collect()))
    assert dedup.line_dedup(docs.limit(0), ["id"], "site").count() == 0


def test_node_line_dedup_keeps_null_keys_and_can_drop_emptied_nodes(spark):
    rows = [(1, "http://s/1", "a"), (1, "http://s/1", "a"), (None, "http://s/2", "a"), (2, "http://t/1", "a")]  # "own" occurs thrice on s, too
    nodes = F.transform(F.array("t", F.lit("own")), lambda t: F.struct(t.alias("text"), F.lit(None).alias("meta"))).cast(f"array<{NODE}>")
    docs = spark.createDataFrame(rows, "id long, url string, t string").withColumn("nodes", nodes).drop("t")
    kept = pipeline.line_dedup(docs, "id", min_count=3)
    texts = sorted((r.id is None, r.id, [n.text for n in r.nodes]) for r in kept.collect() if r.id is not None)
    assert kept.count() == 4 and texts == [(False, 1, ["", ""])] * 2 + [(False, 2, ["a", "own"])]
    assert sorted(len(r.nodes) for r in pipeline.line_dedup(docs, "id", min_count=3, drop_emptied=True).collect()) == [0, 0, 0, 2]


def test_pages_of_any_depth(spark):
    page = "<html><body>" + "<div>" * 5000 + "<p>Deep text</p>" + "</div>" * 5000 + "</body></html>"
    pages = spark.createDataFrame([(1, "http://e.com/a", page)], "id long, url string, html string")
    assert H.dom_levels(pages).where("text = 'Deep text'").count() == 1
    row = H.web_documents(pages).first()
    assert not row.extract_error and [n.text for n in row.nodes] == ["Deep text"]


def test_limits_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "limits.yaml"
    path.write_text("cond_check_number_words_node_level: True\nnumber_words_node_level_min_cutoff: 7\ncond_check_lang_id_node_level: False\nlang_id_node_level_min_cutoff: 0.8\nnumber_words_doc_level_min_cutoff: 11\ncond_check_perplexity_score_doc_level: False\nperplexity_score_doc_level_max_cutoff: 9\n")
    node, doc = (filters.TextLimits.from_yaml(str(path), level) for level in ("node", "doc"))
    assert (node.least_words, node.language, doc.least_words, doc.perplexity, doc.language) == (7, None, 11, None, 0.8)
    path.write_text("least_words: 3\n")
    assert filters.TextLimits.from_yaml(str(path)).least_words == 3
    path.write_text("other: 3\n")
    with pytest.raises(ValueError):
        filters.TextLimits.from_yaml(str(path))

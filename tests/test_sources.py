"""Ranged reads, image archives, downloads, and paced calls."""

import io
import json
import os
import random
import tarfile
import threading

import pytest
from pyspark.sql import functions as F

from folioloom import queries
from folioloom.plans import models
from folioloom.sources import archives, calls, crawl, ranges

DIR = "/root/testdata/sf0.001"


class LoggedReader(ranges.LocalReader):
    """Writes down every read; the first ``bad`` reads of a place fail, those of the name "never" always."""

    def __init__(self, root, log, bad=0):
        super().__init__(root)
        self.log, self.bad = log, bad

    def read(self, name, offset, length):
        fd = os.open(f"{self.log}/{name}-{offset}-{length}", os.O_CREAT | os.O_APPEND | os.O_RDWR)
        os.write(fd, b"x")
        times = os.fstat(fd).st_size
        os.close(fd)
        if times <= self.bad or name == "never" or name == "b" and offset <= 777 < offset + length:
            raise OSError("no answer")
        return super().read(name, offset, length)


def reads(log):
    return [tuple(p.name.rsplit("-", 2)) for p in log.iterdir() for _ in range(p.stat().st_size)]


@pytest.fixture
def files(tmp_path):
    rng = random.Random(2)
    for name in ("a", "b", "c"):
        (tmp_path / name).write_bytes(rng.randbytes(50_000))
    (tmp_path / "log").mkdir()
    return tmp_path


def test_near_ranges_are_read_together(spark, files):
    rng = random.Random(3)
    places = [("a", k * 100, 100) for k in range(100)] + [("a", 20_000 + k, 50) for k in range(20)] + [("c", rng.randrange(49_000), rng.randrange(900)) for _ in range(50)]
    places += [("a", 0, 100), ("a", 49_990, 100), ("c", 60_000, 10), ("c", 5, 0), (None, 1, 1), ("c", None, 1)]
    rows = spark.createDataFrame([(k, *p, None, "other") for k, p in enumerate(places)], "id long, name string, offset long, size long, data binary, error_2 string")
    root, log = str(files), str(files / "log")
    out = ranges.read_ranges(rows, ("name", "offset", "size"), ("data", "error"), lambda: LoggedReader(root, log), gap=500, most=5000, attempts=2, first_wait=0.01, part=1 << 30)
    got = {r.id: r for r in out.coalesce(1).collect()}
    single = ranges.LocalReader(root)
    for k, p in enumerate(places):
        want = (b"", "no place to read") if None in p else (single.read(*p), "")
        assert (bytes(got[k].data), got[k].error, got[k].error_2) == (*want, "other")
    assert len(places) == len(got)
    made = reads(files / "log")
    assert len(made) <= 45 and all(int(n) <= 5000 for _, _, n in made)  # 176 ranges
    assert sum(name == "a" for name, _, _ in made) <= 9


def test_failed_reads_are_tried_again_and_bad_ranges_fail_alone(spark, files):
    places = [("b", 700 + k * 10, 10) for k in range(20)] + [("never", 0, 5), ("a", 0, 5)]
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "id long, name string, offset long, size long")
    root, log = str(files), str(files / "log")
    read = lambda attempts: {r.id: (bytes(r.data), r.error) for r in ranges.read_ranges(rows, ("name", "offset", "size"), ("data", "error"), lambda: LoggedReader(root, log, bad=2), attempts=attempts, first_wait=0.01).collect()}
    got = read(4)
    single = ranges.LocalReader(root)
    for k, p in enumerate(places):
        assert got[k] == ((b"", "OSError('no answer')") if p[0] == "never" or p == ("b", 770, 10) else (single.read(*p), ""))


def test_download_takes_up_a_failed_run(spark, files):
    rows = [("a", 0, 9, b"kept", ""), ("a", 9, 9, b"", "failed before"), ("c", 0, 4, None, None)]
    pointers = spark.createDataFrame(rows, "warc_filename string, warc_record_offset long, warc_record_length long, warc binary, warc_error string")
    root, log = str(files), str(files / "log")
    got = {(r.warc_filename, r.warc_record_offset): (bytes(r.warc), r.warc_error) for r in crawl.download_warc(pointers, lambda: LoggedReader(root, log)).collect()}
    single = ranges.LocalReader(root)
    assert got == {("a", 0): (b"kept", ""), ("a", 9): (single.read("a", 9, 9), ""), ("c", 0): (single.read("c", 0, 4), "")}
    assert sorted(reads(files / "log")) == [("a", "9", "9"), ("c", "0", "4")]
    assert crawl.download_warc(pointers.limit(0), lambda: LoggedReader(root, log)).count() == 0


def add(tar, name, data):
    info = tarfile.TarInfo(name)
    info.size = len(data)
    tar.addfile(info, io.BytesIO(data))


def test_large_archive_in_bounded_memory(spark, tmp_path, monkeypatch):
    """Ten thousand members: headers are walked without the pictures, and pictures come in reads of a bounded size."""
    path, size = tmp_path / "big.tar", 20_000
    with tarfile.open(path, "w", format=tarfile.PAX_FORMAT) as tar:
        for k in range(5000):
            add(tar, f"{k:09d}.jpg", k.to_bytes(4, "big") * (size // 4))
            url = f"http://e.com/{k % 4000}"  # the last thousand names take over addresses of the first
            add(tar, f"{k:09d}.json", json.dumps({"url": url, "status": "failed" if k % 10 == 3 else "success"}).encode())
        add(tar, "folder/" + "n" * 120 + ".jpg", b"long name")
        add(tar, "folder/" + "n" * 120 + ".json", b'{"url": "long", "status": "success"}')
        add(tar, "alone.json", b'{"url": "lost", "status": "success"}')
    asked = []
    whole = ranges.StoreReader.read
    monkeypatch.setattr(ranges.StoreReader, "read", lambda self, name, offset, length: asked.append(length) or whole(self, name, offset, length))
    with tarfile.open(fileobj=archives.HeaderFile(str(path), path.stat().st_size), mode="r:") as tar:
        assert sum(1 for _ in tar) == 10_003
    assert sum(asked) < 0.6 * path.stat().st_size and max(asked) <= archives.AHEAD
    got = archives.images(spark, str(path), most=1 << 20, part=1 << 24)
    rows = {r.url: (r.n, bytes(r.head)) for r in got.select("url", F.length("image").alias("n"), F.substring("image", 1, 4).alias("head")).collect()}
    want = {f"http://e.com/{k % 4000}": (size, k.to_bytes(4, "big")) for k in range(5000) if k % 10 != 3}
    assert rows == want | {"long": (9, b"long")}
    assert got.rdd.getNumPartitions() == 5  # 72 MB by 16: one archive is read by several tasks


class FakeFetcher:
    def get(self, url):
        if url.endswith("7"):
            raise ConnectionError("gone")
        return url.encode() * 10


def test_download_and_archives_round_trip(spark, tmp_path):
    urls = spark.createDataFrame([(f"http://e.com/{k % 100}",) for k in range(150)] + [(None,)], "url string")
    out = f"{tmp_path}/shards"
    archives.download(urls.repartition(3), FakeFetcher, out, threads=4, attempts=2, resize=lambda b: b[:20] if b"/9" not in b else b[:-1000], per_shard=30)
    names = sorted(os.listdir(out))
    shards = [n for n in names if n.endswith(".tar")]
    assert "_SUCCESS" in names and "_temporary" not in names and len(names) == 3 * len(shards) + 1
    stats = [json.load(open(f"{out}/{n.removesuffix('.tar')}_stats.json")) for n in shards]
    assert sum(s["count"] for s in stats) == 100 and sum(s["successes"] for s in stats) == 90 and max(s["count"] for s in stats) <= 30
    listed = spark.read.parquet(f"{out}/*.parquet")
    assert listed.count() == 100 and listed.where("status = 'failed_to_download' and error like '%gone%'").count() == 10
    got = {r.url: bytes(r.image) for r in crawl.images_from_tars(spark, f"{out}/*.tar").collect()}
    assert got == {u: (u.encode() * 10)[:20] if "/9" not in u else (u.encode() * 10)[:-1000] for u in (f"http://e.com/{k}" for k in range(100)) if not u.endswith("7")}
    with pytest.raises(Exception, match="already has shards"):
        archives.write_archives(archives.fetch(urls, FakeFetcher), out)
    archives.write_archives(spark.createDataFrame([], archives.FETCHED), f"{tmp_path}/none")
    assert [n for n in os.listdir(f"{tmp_path}/none") if n.endswith(".tar")] == []


def test_no_shard_remains_of_a_failed_job(spark, tmp_path):
    out = f"{tmp_path}/shards"
    bad = F.when(F.col("id") == 999, F.raise_error(F.lit("broken row")).cast("binary")).otherwise(F.encode(F.col("id").cast("string"), "utf-8"))
    rows = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("url"), bad.alias("image"), F.lit("success").alias("status"), F.lit("").alias("error"))
    with pytest.raises(Exception, match="broken row"):
        archives.write_archives(rows, out, per_shard=10)
    assert not os.path.exists(out) or os.listdir(out) == []


def test_shard_bytes(spark, tmp_path):
    rows = spark.range(0, 40, 1, 1).select(F.col("id").cast("string").alias("url"), F.encode(F.repeat(F.lit("x"), 1000), "utf-8").alias("image"), F.lit("success").alias("status"), F.lit("").alias("error"))
    archives.write_archives(rows, f"{tmp_path}/s", shard_bytes=5000)
    sizes = [json.load(open(f"{tmp_path}/s/{n}"))["bytes"] for n in os.listdir(f"{tmp_path}/s") if n.endswith("_stats.json")]
    assert len(sizes) == 10 and max(sizes) <= 6000


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds


def test_bucket_keeps_the_rate():
    clock = Clock()
    bucket, times = calls.Bucket(20, 2, clock, clock.sleep), []
    for _ in range(102):
        bucket.take()
        times.append(clock.now)
    assert times[-1] == pytest.approx(5.0) and all(b - a >= 0.05 - 1e-9 for a, b in zip(times[1:], times[3:], strict=False))
    clock.now += 100  # no more than the burst is saved up
    before = clock.now
    for _ in range(4):
        bucket.take()
    assert clock.now - before == pytest.approx(0.1)


def test_calls_in_flight_are_bounded_and_in_order():
    now, most, lock = 0, 0, threading.Lock()

    def call(x):
        nonlocal now, most
        with lock:
            now += 1
            most = max(most, now)
        threading.Event().wait(0.002 * (x % 3))
        with lock:
            now -= 1
        return x * x

    assert list(calls.in_flight(call, range(60), 5)) == [(k, k * k) for k in range(60)] and most <= 5
    assert list(calls.in_flight(call, [], 5)) == []
    with pytest.raises(ZeroDivisionError):
        list(calls.in_flight(lambda x: 1 // (x - 7), range(20), 3))


def test_tried_waits_as_told():
    clock, left = Clock(), [3]

    def call():
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("busy")
        return "done"

    assert calls.tried(call, [1, 5, 10, 60], clock.sleep) == "done" and clock.slept == [1, 5, 10]
    left[0] = 9
    with pytest.raises(OSError):
        calls.tried(call, [1, 5], clock.sleep)
    assert calls.backoff(5, 1, 4) == [1, 2, 4, 4]


class Service:
    """Flags addresses that end in 0; notes down every call, and fails as often as it is told for each."""

    def __init__(self, log, fails):
        self.log, self.fails, self.seen = log, fails, {}

    def opted_out(self, urls):
        assert 1 < len(urls) <= 10
        self.seen[urls[0]] = self.seen.get(urls[0], 0) + 1
        if self.seen[urls[0]] <= self.fails:
            raise ConnectionError("busy")
        with open(f"{self.log}/{os.getpid()}", "a") as f:
            f.write(f"{len(urls)}\n")
        return [u.endswith("0") for u in urls]


def test_opt_out_calls(spark, tmp_path):
    log = str(tmp_path)
    urls = spark.createDataFrame([(f"u{k % 93}",) for k in range(200)] + [(None,)], "url string")
    ask = lambda fails, waits: models.opted_out(urls, lambda: Service(log, fails), per_call=10, calls_a_second=200, at_once=6, tasks=3, waits=waits)
    want = sorted(f"u{k}" for k in range(93) if k % 10 == 0)
    assert sorted(r.url for r in ask(2, [0.01] * 2).collect()) == want
    made = [int(x) for p in tmp_path.iterdir() for x in p.read_text().split()]
    assert len(made) <= 12 and 93 <= sum(made) <= 96
    with pytest.raises(Exception, match="busy"):
        ask(3, [0.01] * 2).collect()
    assert models.opted_out(urls.limit(0), lambda: Service(log, 0)).count() == 0


def test_numbering_without_python_or_rdd(spark):
    from folioloom.operators import stats

    rows = spark.range(0, 1000, 1, 7).select(((F.col("id") * 7919) % 1000).alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id").cast("string")).alias("s"))
    out, n = stats.numbered(rows, ["s", "k"], ranges=16)
    got = out.orderBy("index").collect()
    assert n == 1000 and [r["index"] for r in got] == list(range(1000))
    assert [(r.s, r.k) for r in got] == sorted(((r.s, r.k) for r in got), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Scan ExistingRDD" not in plan
    ranges_ = rows.select(stats.range_of(rows, ["s", "k"], 16).alias("r")).groupBy("r").count().collect()
    assert len(ranges_) == 16 and max(r["count"] for r in ranges_) < 200
    empty, n = stats.numbered(rows.limit(0), ["k"])
    assert n == 0 and empty.count() == 0
    split = queries.shard_split(spark, DIR)
    assert "Python" not in split._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [5, 10_000])
def test_exact_quantiles_in_bounded_state(spark, monkeypatch, few):
    import numpy as np

    from folioloom.operators import stats

    monkeypatch.setattr(stats, "FEW", few)
    rng = np.random.default_rng(6)
    for values in (rng.normal(size=3000), np.repeat([1.0, 2.0, 5.0], [500, 30, 900]), np.arange(50.0), np.array([7.0]), np.concatenate([np.zeros(800), rng.random(100), np.ones(800)])):
        df = spark.createDataFrame([(float(x),) for x in values] + [(None,)] * 5, "x double")
        for share in (0.0, 0.05, 0.5, 0.95, 1.0):
            assert stats.quantile(df, "x", share, len(values)) == pytest.approx(float(np.quantile(values, share)), abs=1e-12), share
    assert stats.histogram(spark.createDataFrame([(None,)], "x double"), "x").count() == 0
    same = stats.histogram(spark.createDataFrame([(3.0,)] * 4, "x double"), "x").collect()
    assert [(r.bin, r.n) for r in same] == [(0, 4)]


def test_signatures_are_grouped_once(spark):
    plan = queries.imgset_dedup(spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem.parquet") <= 3
    assert queries.retained_discarded(spark, DIR)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


# Sentences of one declaration, and each charset that can write them.
SAID = {
    "Die schöne Müllerin läuft über die Brücke; größere Städte führen zu längeren Wegen. Übung macht den Meister.": ["windows-1252", "utf-8"],
    "L'été dernier, nous avons visité un château près de la forêt où un élève à l'âge avancé déjà rêvait d'être poète.": ["windows-1252"],
    "El niño pequeño comió una manzana en la montaña; mañana irá a la escuela con su compañero. ¿Dónde está él?": ["windows-1252"],
    "Zażółć gęślą jaźń. Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.": ["iso-8859-2", "windows-1250"],
    "Все люди рождаются свободными и равными в своём достоинстве и правах. Они наделены разумом.": ["windows-1251", "koi8-r", "utf-16-be", "utf-8"],
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.": ["windows-1253"],
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。カタカナ": ["shift_jis", "euc_jp", "utf-16-le"],
    "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았다.": ["euc_kr"],
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。中国的首都是北京。": ["gb18030"],
    "人人生而自由,在尊嚴和權利上一律平等。他們賦有理性和良心,並應以兄弟關係的精神相對待。我們都很喜歡這個城市。": ["big5"],
    "All human beings are born free and equal.": ["utf-16-le", "ascii"],
}


@pytest.mark.parametrize("said", SAID)
def test_charsets(said):
    from folioloom.sources.charsets import detect

    page = f"<html><body><p>{said}</p><a href='/next.html'>more</a></body></html>"
    for charset in SAID[said]:
        assert page.encode(charset).decode(detect(page.encode(charset))) == page, charset
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page.encode(charset)
        record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"
        assert crawl.html_of(record) == (page, ""), charset


def test_charset_of_odd_bytes():
    from folioloom.sources.charsets import detect

    rng = random.Random(1)
    for n in (1, 2, 3, 100, 5000):
        for _ in range(20):
            data = rng.randbytes(n)
            data.decode(detect(data), "replace")
    assert detect(b"") == "utf-8"
    assert detect("x".encode("utf-8-sig")) == "utf-8-sig"


def test_video_and_audio_nodes(spark):
    from folioloom.operators import filters
    from folioloom.operators.documents import from_wire, found_counts, image_sources, to_wire
    from folioloom.plans import html, pipeline

    page = (
        "<p>before the film</p><video src='/film.mp4' width='640' height='360'></video><p>between them</p>"
        "<audio><source src='http://e.com/sound.mp3'></audio><img src='/a.png' width='300px'><video></video><p>at the end</p>"
    )
    pages = spark.createDataFrame([(1, "http://e.com/p", page)], "id long, url string, html string")
    all_kinds = html.ExtractOptions(only_text_and_images=False)
    docs = html.web_documents(pages, options=all_kinds)
    told = [(n.text, n.meta and (n.meta.media, n.meta.src, n.meta.rendered_width)) for n in docs.first().nodes]
    want = [
        ("before the film", None), (None, ("video", "https://e.com/film.mp4", "640")), ("between them", None), (None, ("audio", "http://e.com/sound.mp3", None)),
        (None, (None, "https://e.com/a.png", "300")), ("at the end", None),
    ]
    assert told == want
    assert [n.meta.src for n in html.web_documents(pages).first().nodes if n.meta] == ["https://e.com/a.png"]
    assert docs.select(image_sources(F.col("nodes")).alias("s")).first().s == ["https://e.com/a.png"]
    assert tuple(docs.select(*found_counts(F.col("nodes"))).first()) == (1, 0)
    loose = filters.TextLimits(least_words=1, stopwords=None, common=None, flagged=None, punctuation=None, char_repetition=None, word_repetition=None)
    kept = filters.filter_nodes(docs, loose, filters.image_ok).first().nodes  # the image has no size and goes
    assert [n.meta.media for n in kept if n.meta] == ["video", "audio"]
    assert [n.meta.media for n in pipeline.remove_frequent_images(docs, "id", 0).first().nodes if n.meta] == ["video", "audio"]
    wire = to_wire(docs.withColumn("general_metadata", F.lit(None).cast("string")))
    back = from_wire(wire).first().nodes
    assert [(n.text, n.meta and (n.meta.media, n.meta.src, n.meta.rendered_width)) for n in back] == want


def test_probed_sizes_in_nodes(spark):
    from folioloom.operators.documents import NODE
    from folioloom.plans import pipeline

    node = lambda text, src, media=None: f"named_struct('text', {text}, 'meta', {'null' if src is None else f"from_json('{{\"src\": \"{src}\", \"format\": \"own\"{f', \"media\": \"{media}\"' if media else ''}}}', '{NODE.split('meta:')[1][:-1]}')"})"
    nodes = f"cast(array({node('null', 'a')}, {node("'x'", None)}, {node('null', 'b')}, {node('null', 'a')}, {node('null', 'a', 'video')}) as array<{NODE}>)"
    docs = spark.createDataFrame([(1,), (1,), (None,)], "id int").selectExpr("id", f"{nodes} as nodes")
    docs = docs.unionByName(spark.sql(f"select 2 as id, cast(null as array<{NODE}>) as nodes")).unionByName(spark.sql(f"select 3 as id, cast(array() as array<{NODE}>) as nodes"))
    facts = spark.createDataFrame([("a", "png", 10, 20), ("a", "gif", 1, 2), ("c", "gif", 5, 5), (None, "gif", 5, 5)], "src string, format string, width int, height int")
    rows = pipeline.with_probed_sizes(docs, facts).collect()
    seen = {r.id: r.nodes and [(n.text, n.meta and (n.meta.src, n.meta.format, n.meta.original_width, n.meta.original_height)) for n in r.nodes] for r in rows}
    want = [(None, ("a", "png", 10, 20)), ("x", None), (None, ("b", "own", None, None)), (None, ("a", "png", 10, 20)), (None, ("a", "own", None, None))]
    assert seen == {1: want, None: want, 2: None, 3: []} and len(rows) == 5
    same = pipeline.with_probed_sizes(docs, facts.limit(0)).collect()
    assert sorted(map(repr, same)) == sorted(map(repr, docs.collect()))

import gzip
import hashlib
import math
import time
from collections import Counter

import pytest

from ebbflow.llm import common, license_scan, url_filter, warc


@pytest.fixture(scope="module")
def pages(spark):
    big, rows = "é" * 700, []
    rows += [(i, f"http://h{i}.com/en/{i}", big, "x") for i in range(5)]
    rows += [(5, None, None, None), (6, "no scheme", "", "y"), (7, "http://a b\n.org/é?q", "small", ""), (8, "https://Www.Example.COM/en/x#f", "<p>\r\n\r\n</p>" * 400, None)]
    rows += [(None, "http://x.net/fr/", big, "n"), (9, "http://net/es", "small", "z"), (4, "http://again.com", big, "dup")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, rule string")


def test_warc_round_trip(spark, pages):
    archives = warc.write(pages, common.new_path(spark, "warc-test"))
    members = warc.normalised(archives)
    got = sorted((tuple(r) for r in warc.read(members).collect()), key=repr)
    want = []
    for r in pages.collect():
        payload = (r.html or "").encode()
        again = len(payload) >= 1000 and payload == ("é" * 700).encode() and r.page_id != 4
        want.append((r.page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", 4 if again else None))
    assert got == sorted(want, key=repr)


def test_members_are_the_archive(spark, pages):
    archives = warc.write(pages, common.new_path(spark, "warc-members"))
    for r in warc.normalised(archives).collect():
        path = r.archive.removeprefix("file://")
        whole = gzip.open(path.replace(".members", "")).read()
        assert gzip.open(path).read() == whole
        index = list(warc.Archive(r.archive, r["index"]).index())
        data, at = open(path, "rb").read(), 0
        for offset, length, _, _ in index:
            assert offset == at and gzip.decompress(data[offset : offset + length]).startswith(b"WARC/1.1\r\n")
            at += length
        assert at == len(data) and r.records == len(index)


def test_cut_archive_fails(tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(warc.record(1, "u", b"x" * 5000, "00" * 20, None, False))[:-30])
    with pytest.raises(ValueError):
        warc.normalise(f"file://{tmp_path}/a.warc.gz", f"file://{tmp_path}/b", f"file://{tmp_path}/c")


def test_no_pages(spark, pages):
    members = warc.normalised(warc.write(pages.limit(0), common.new_path(spark, "warc-none")))
    assert warc.read(members).count() == 0


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("h1.com", "/e", "block"), (None, "/", "block"), ("h2.com", "/en/2", "allow"), ("h2.com", "/en/2", "block")]


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_url_rules(spark, pages):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_filter.judge(pages, rules)
    assert got.count() == pages.count() and set(got.columns) == {"page_id", "url", "html", "host", "path", "rule", "verdict"}
    for r in got.collect():
        host, path = split(r.url)
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, 0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[2], best[3])
    assert url_filter.judge(pages, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == pages.count()
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_shuffled_rules_agree(spark, pages, monkeypatch):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    want = sorted(map(repr, url_filter.judge(pages, rules).collect()))
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    assert sorted(map(repr, url_filter.judge(pages, rules).collect())) == want


def test_many_shapes_and_one_common_url(spark):
    hosts = [".".join(["h"] * n) for n in range(1, 30)]
    rules = spark.createDataFrame([(h, "/" * k, "block" if k % 2 else "allow") for h in hosts for k in (1, 2, 40)], "host string, path string, verdict string")
    rows = [(i, "s://" + "h." * 20 + "h///x", "a", "b") for i in range(300)] + [(300, "x://y.h/", "a", "b"), (301, "x://y", "a", "b"), (302, "x://h.h/", "a", None)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, copies string, lengths string"), rules)
    assert got.columns == ["page_id", "url", "copies", "lengths", "host", "path", "rule", "verdict"]
    out = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert {out[i] for i in range(300)} == {("h." * 20 + "h//", "allow")} and out[300] == ("h/", "block") and out[301] == (None, "allow") and out[302] == ("h.h/", "block")


TEMPLATES = [("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("None", None)]


def test_licences(spark):
    rows = [
        ("a/x/1", "MIT License, released under the\nother words here", False), ("a/x/LICENSE", "text\nLicensed under the Apache License, Version 2.0.", True),
        ("a/x/2", "nothing here", False), ("a/x/y/z/3", "of the", False), ("a/4", None, False), ("b/5", "", False), (None, "Released under the MIT License.", False), ("c", "x", False), ("a/x/2", "nothing here", False),
    ]
    files = spark.createDataFrame(rows, "path string, text string, is_license_file boolean")
    got = license_scan.licences(files, spark.createDataFrame(TEMPLATES, "license_id string, text string"), 0.7)
    out = Counter((r.path, r.license_id, r.inherited, r.from_dir) for r in got.collect())
    assert out == Counter({
        ("a/x/1", "MIT", False, None): 1, ("a/x/LICENSE", "Apache-2.0", False, None): 1, ("a/x/2", "Apache-2.0", True, "a/x"): 2, ("a/x/y/z/3", "Apache-2.0", True, "a/x"): 1,
        ("a/4", None, False, None): 1, ("b/5", None, False, None): 1, (None, "MIT", False, None): 1, ("c", None, False, None): 1,
    })
    assert license_scan.licences(files.limit(0), spark.createDataFrame(TEMPLATES, "license_id string, text string")).count() == 0


def test_cosine_by_hand():
    w = license_scan.Weights([("A", "red blue"), ("B", "red green")], 10, {"red": 5, "blue": 1})
    idf = {"red": math.log(11 / 6) + 1, "blue": math.log(11 / 2) + 1}
    a, b = [idf["red"], idf["blue"]], [idf["red"], idf["blue"] * 2]
    want = (a[0] * b[0] + a[1] * b[1]) / math.hypot(*a) / math.hypot(*b)
    assert w.best("Blue, red! BLUE") == ("A", pytest.approx(want))
    assert w.best("yellow") is None


@pytest.mark.parametrize("n", [60, 2000])
def test_wrapped_embedded_and_whole_licences(spark, n):
    from ebbflow.llm import queries

    texts = dict(queries.LICENSE_TEXTS)
    header = next(t for name, t in queries.LICENSE_TEXTS if t.startswith("Licensed under the Apache"))
    filler = [(f"f{i}", "the work is of a kind that you and the others use under this and that " + " ".join(f"w{(i * k) % 97}" for k in range(1, 40))) for i in range(n)]
    rows = [
        ("wrapped", "some w1 w2\nThis work is licensed under the GNU General\nPublic License, version 3.\nw3 w4 and the w5"),
        ("embedded", "w9 w8 of the w7 and w6 Released under the MIT License. w5 w4 " + "w3 of the w2 " * 30),
        ("whole", texts["GPL-3.0-only"].replace("Everyone", "Anyone")), ("short", "Copyright 2020 A. Body\n\n" + texts["MIT"]),
        ("header", "Copyright 2020 A. Body\n" + header + "\n\n" + "w1 of w2\n" * 50), ("inside", "w1 w2 w3\n" * 40 + texts["BSD-3-Clause"] + "w4 w5\n" * 40),
    ]
    files = spark.createDataFrame(filler + rows, "path string, text string")
    templates = spark.createDataFrame(queries.LICENSES + queries.LICENSE_TEXTS, "license_id string, text string")
    got = {r.path: r for r in license_scan.matched(files, templates).where("license_id is not null").collect()}
    want = {"wrapped": ("GPL-3.0-only", 1), "embedded": ("MIT", 0), "whole": ("GPL-3.0-only", 0), "short": ("MIT", 2), "header": ("Apache-2.0", 1), "inside": ("BSD-3-Clause", 40)}
    assert {p: r.license_id for p, r in got.items()} == {p: w[0] for p, w in want.items()}
    assert {p: r.line for p, r in got.items() if p in ("wrapped", "embedded", "inside")} == {"wrapped": 1, "embedded": 0, "inside": 40}
    assert got["whole"].whole and not got["inside"].whole and all(r.cosine > 0.9 for r in got.values())


def test_windows_by_hand():
    rng, names = __import__("random").Random(1), ["red", "blue", "green", "a", "b"]
    words = rng.choices(names, k=60)
    w = license_scan.Weights([("T", "red blue green red")], 50, {"red": 9, "a": 40, "b": 3})
    got = w.match(license_scan.terms(" ".join(words)), [], 0.1)
    want = max(w.best(" ".join(words[i : i + 4]))[1] if w.best(" ".join(words[i : i + 4])) else 0 for i in range(57))
    assert got[1] == pytest.approx(want) and w.best(" ".join(words[got[2] : got[3]]))[1] == pytest.approx(want)


def test_hosts_of_very_many_labels(spark):
    """Suffixes are made for the rules' label counts alone, so a long host takes a moment."""
    rules = spark.createDataFrame([("a.b", "", "block"), ("b", "", "allow"), ("x.a.b", "/q", "allow")], "host string, path string, verdict string")
    hosts = ["y." * 100_000 + "a.b", "x." * 50_000 + "a.b/q", "." * 20_000 + "b", "a.b.c", ""]
    pages = spark.createDataFrame([(k, f"http://{h}") for k, h in enumerate(hosts)], "page_id int, url string")
    began = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules, default="block").collect()}
    assert got == {0: ("a.b", "block"), 1: ("x.a.b/q", "allow"), 2: ("b", "allow"), 3: (None, "block"), 4: (None, "block")}
    assert time.time() - began < 60

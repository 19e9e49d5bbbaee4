"""URL rules, source mixing and WARC archives on small tables."""

import base64
import gzip
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from arealytics.llm import mixing, url_rules, warc


def test_stated_rules_and_parts(spark):
    urls = {
        1: "http://a.Example.ORG/en/17?x", 2: "https://example.org/es/1", 3: "http://x.org", 4: None,
        5: "no scheme", 6: "http://shop.com/de/1#t", 7: "http://shop.com/fr/", 8: "http://notexample.org/es/",
        9: "", 10: "http://example.net/en/1",
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in urls.items()], "page_id long, url string, host string")
    found = {r.page_id: r for r in url_rules.filter_urls(pages).collect()}
    assert (found[1].host, found[1].path, found[1].rule) == ("a.example.org", "/en/17", "example.org/en/1")
    assert found[2].rule == "example.org/es/" and found[2].verdict == "block"
    assert found[3].rule is None and found[3].path == ""  # an empty path starts with no slash
    assert all((found[i].host, found[i].path) == ("", "") for i in (4, 5, 9))
    assert found[6].rule == "com/de/" and found[7].rule == "com/fr/" and found[8].rule == "org/"
    assert all(r.verdict in ("allow", "block") for r in found.values())


def test_mined_rules_equal_counting(spark):
    draw = random.Random(3)
    rows = []
    for i in range(300):
        lang, shop = draw.choice(["de", "fr", "en"]), draw.choice(["a", "b", "c"])
        bad = (lang == "de" and draw.random() < 0.9) or (shop == "c" and draw.random() < 0.7)
        rows.append(([f"p:{lang}", f"h2:{shop}", "h0:com"], "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, label string")
    found = {
        (tuple(r.antecedent), r.label): (r.confidence, r.support, r.rarest)
        for r in url_rules.mine(labelled, 0.02, 0.6).collect()
    }
    assert (("p:de",), "block") in found
    for (tokens, label), (confidence, support, rarest) in found.items():
        fits = [l for t, l in rows if set(tokens) <= set(t)]
        assert confidence == pytest.approx(fits.count(label) / len(fits))
        assert support == pytest.approx(fits.count(label) / len(rows))
        assert rarest in tokens
        for part in tokens if len(tokens) > 1 else ():
            rest = [l for t, l in rows if set(tokens) - {part} <= set(t)]
            assert rest.count(label) / len(rest) < confidence
    asked = spark.createDataFrame(
        [("u1", ["p:de", "h2:a", "h0:com"]), ("u2", ["p:xx"]), ("u3", [])], "url string, tokens array<string>"
    )
    judged = {r.url: r.label for r in url_rules.judge(asked, url_rules.mine(labelled, 0.02, 0.6)).collect()}
    best = max(
        ((c, s, -len(t), t, l) for (t, l), (c, s, _) in found.items() if set(t) <= {"p:de", "h2:a", "h0:com"})
    )
    assert judged == {"u1": best[-1]}


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_rules.filter_urls(pages).collect()} == {"allow"}
    assert url_rules.filter_urls(pages.where("false")).count() == 0


DOCS = "doc_id long, text string, source string, size string, target string, _key string"


def test_mix_targets_and_copies(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 5}", "x", "y", "z") for i in range(400)]
    rows += [(500, None, None, "", "", ""), (501, "a b", None, "", "", ""), (501, "a b", None, "", "", ""),
             (None, "c", "s1", "", "", ""), (502, "", "empty", "", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    assert sum(r.size for r in found) == sum(len((r[1] or "").split()) for r in rows)
    sources = {}
    for r in rows:
        sources[r[2]] = sources.get(r[2], 0) + len((r[1] or "").split())
    # targets by filling up, source by source
    order = sorted((s for s in sources if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_sources, left = {}, set(order), 1.5 * sum(sources.values())
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if weight[s] * level > 2 * sources[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_sources}
            break
        target |= {s: 2.0 * sources[s] for s in over}
        left -= sum(target[s] for s in over)
        open_sources -= over
    by_size = {}
    for s in order:
        by_size.setdefault(sources[s], set()).add(round(target[s], 6))
    assert all(round(r.target, 6) in by_size[r.source_size] for r in found)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))

    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns
    times = {r.doc_id: r.taken // r.size for r in found if r.size and r.doc_id not in (None, 501)}
    counted = {r.doc_id: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert all(counted.get(i, 0) == n for i, n in times.items())


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixing.mix(docs).count() == 0 and mixing.emit(docs).count() == 0
    empty = spark.createDataFrame([(1, None, "a", "", "", "")], DOCS)
    assert [(r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0.0, 0)]


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROWS_PER_ARCHIVE", 3)
    tricky = "WARC/1.1\r\nContent-Length: 9\r\n\r\nx\r\n\r\n"
    rows = [
        (1, "http://b.org/x", "äöü", 0), (2, "http://a.org/", "äöü", 0), (3, None, None, 0), (4, "", "", 0),
        (5, "http://a.org/\r\nX: y", tricky, 0), (6, "http://a.org/", tricky, 0), (6, "http://a.org/", tricky, 0),
        (None, "http://c.org", "alone", 0), (8, "http://a.org/", "z" * 50_000, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, offset int")
    found = warc.capture_histories(pages).collect()
    assert len(found) == len(rows)
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in found]
    assert keys == sorted(keys)
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    expected = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        response = i is None or first[html or ""] == i
        expected.append((
            i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
            "response" if response else "revisit", None if response else first[html or ""],
        ))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")],
                                  "page_id long, url string, html string")
    found = {r.page_id: r.record_type for r in warc.capture_histories(pages, min_bytes=3).collect()}
    assert found == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.capture_histories(pages.where("false")).count() == 0


def test_loser_tree_merges():
    draw = random.Random(5)
    for count in (0, 1, 2, 3, 7, 16):
        runs = [sorted(draw.choices(range(50), k=draw.randint(0, 9))) for _ in range(count)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_emit_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(i, "a b c", "x" if i % 3 else None, "mine", "own", "also", "row") for i in range(40)],
        "doc_id long, text string, source string, _mix_key string, _mix string, _mix_copy string, row string",
    )
    out = mixing.emit(docs)
    assert out.columns == docs.columns and out.count() > 40
    assert {tuple(r)[3:] for r in out.collect()} == {("mine", "own", "also", "row")}


def test_archives_of_many_members():
    def one(number, body):
        head = f"WARC/1.1\r\nWARC-Type: response\r\nX: {number}\r\nContent-Length: {len(body)}\r\n\r\n"
        return head.encode() + body + b"\r\n\r\n"

    plain = [one(i, b"x" * i) for i in range(5)]
    whole = b"".join(gzip.compress(p) for p in plain)
    found = list(warc.records(whole))
    assert [(f["X"], len(b)) for _, f, b in found] == [(str(i), i) for i in range(5)]
    assert found == list(warc.records(b"".join(plain))) == list(warc.records(gzip.compress(b"".join(plain))))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(whole[:-9]))
    with pytest.raises(zlib.error):
        list(warc.records(whole + b"trailing"))


def test_dates_of_large_ids_have_four_digit_years(spark):
    pages = spark.createDataFrame([(10**18 + 5, "http://a/", "x"), (3, "http://b/", "y")], "page_id long, url string, html string")
    found = warc.capture_histories(pages).collect()
    assert sorted(r.page_id for r in found) == [3, 10**18 + 5]
    archives = warc.with_types(pages.withColumnRenamed("html", "payload"), 0).select(warc.record("2020-01-01 00:00:00").alias("r"))
    dates = [re.search(r"WARC-Date: (\S+)", r.r)[1] for r in archives.collect()]
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", d) for d in dates)


def shop_links(count, fields):
    draw = random.Random(7)
    pages = []
    for i in range(count):
        kind = i % 4
        query = "&".join(f"f{n}=1" for n in range(fields))
        if kind == 0:
            pages.append((i, f"http://s{i}.com/de/x?{query}"))  # blocked, all fields
        elif kind == 1:
            pages.append((i, f"http://s{i}.com/fr/x?f{draw.randrange(fields)}x=1"))
        elif kind == 2:
            pages.append((i, f"http://s{i}.net/?f{draw.randrange(fields)}=1&z={i}"))  # any one field
        else:
            pages.append((i, f"http://s{i}.net/y/{draw.choice(['fr', 'de', 'it'])}"))
    return pages


def test_tokens_that_go_together_are_one_item(spark):
    pages = spark.createDataFrame(shop_links(80, 3), "page_id long, url string")
    rows = pages.select("url").withColumns({"h": url_rules.host("url"), "p": url_rules.path("url")})
    rows = rows.withColumn("tokens", url_rules.tokens("url", "h", "p")).withColumn(
        "label", url_rules.stated(url_rules.RULES, "h", "p")["verdict"]
    )
    labelled, asked = rows.where("label IS NOT NULL").select("tokens", "label"), rows.where("label IS NULL").select("url", "tokens")
    same = url_rules.alike(labelled, 0.01)
    assert {(r.token, r.item) for r in same.collect()} >= {("q:f1", "p:de"), ("q:f0", "p:de")}
    plain = dict(url_rules.judge(asked, url_rules.mine(labelled, 0.01, 0.6)).collect())
    items = url_rules.as_items("tokens", same)
    merged = url_rules.mine(labelled.withColumn("tokens", items), 0.01, 0.6)
    assert dict(url_rules.judge(asked.withColumn("tokens", items), merged).collect()) == plain != {}


def test_links_with_many_fields(spark):
    pages = spark.createDataFrame(shop_links(80, 40), "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_rules.filter_urls(pages).collect()}
    assert len(found) == 80 and all(found[i] == "block" for i in range(2, 80, 4))

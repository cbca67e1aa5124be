"""op8 and op9 on edge cases."""

import base64
import email
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import markup, style_tree, warc

SCHEMA = "page_id long, url string, html string"


def main(page):
    found = list(markup.blocks(page))
    return [b.text for b in found if b.content and not b.noise] or [b.text for b in found if not b.noise]


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><article>";</script><style>p{}</style></head><body class="has-sidebar"><nav><ul><li>menu<li>two</ul></nav>
    <!-- <p>hidden</p> --><header><h1>Site</h1></header><div class="ad">buy</div><main><header><h1>Title &amp;  more</h1></header><p>One <b>bold</b>&nbsp;x<p>Two
    lines<br>end<div class="comments"><p>first!</p></div><aside>side</aside><form>f<input></form><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main><footer>&copy; foot</footer></body>"""
    assert main(page) == ["Title & more", "One bold x", "Two lines end", "a", "b", "c", "d"]


def test_broken_pages():
    assert main(None) == main("") == main("<") == main("<p") == [] or main("<") == ["<"]
    assert main("plain text") == ["plain text"] and main("a < b &lt; c") == ["a < b < c"]
    assert main("<p>x</div></span>y") == ["x", "y"] or main("<p>x</div></span>y") == ["xy"]
    assert main("<article>" * 2000 + "deep" + "</article>" * 1000) == ["deep"]
    assert main("<p>a <button>b</button> c <span class='ad'>d</span>e") == ["a", "c", "e"]
    assert main('<p title="a>b">q</p><script>never closed') == ["q"]


def page(body):
    return f"<html><body>{body}</body></html>"


def test_style_tree(spark):
    rows = [(k, f"http://h.example/{k}", page(f"<div class=teaser><p>Join us</p><p>Now</p></div><div class=text><p>Story {k} is new</p>{'<p>more</p>' * (k % 4)}<p>Line {k * 7}</p></div>")) for k in range(20)]
    rows += [(100, "http://h.example/x", page("<nav>n</nav><article><p>Join us</p></article>")), (101, None, None), (102, "", ""), (103, "http://few.example/", page("<div class=teaser><p>Join us</p></div>")), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit("clash")).withColumn("low", F.lit(0))
    got = {r["page_id"]: r["text"] for r in style_tree.main_text(df).collect()}
    assert style_tree.main_text(df).count() == len(rows)
    assert got[3].startswith("Story 3 is new") and "Join us" not in got[3] and got[3].endswith("Line 21")
    assert got[100] == "Join us" and got[101] == got[102] == "" and got[103] == "Join us"
    assert style_tree.main_text(df.limit(0)).count() == 0


def test_style_tree_decides_inside_and_outside_articles(spark):
    story = lambda k: f"<div class=text><p>Story {k} is new</p>{'<p>more</p>' * (k % 4)}<p>Line {k * 7}</p></div>"
    bodies = [f"<div class=top>Same on all pages</div><div class=lead>Summary {k * 3}</div><article><div class=teaser><p>Join us</p></div>{story(k)}</article>" for k in range(20)]
    rows = [(k, f"http://h.example/{k}", page(b)) for k, b in enumerate(bodies)]
    rows += [(50, "http://few.example/", page(bodies[0]))] + [(60 + k, f"http://same.example/{k}", page(f"<article>Terms of use</article><nav>{k}</nav>")) for k in range(20)]
    got = {r["page_id"]: r["text"].split("\n") for r in style_tree.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    # the tree removes what repeats inside the article, and finds what differs outside it
    assert got[3] == ["Summary 9", "Story 3 is new", "more", "more", "more", "Line 21"]
    # names decide where a host has too few pages
    assert got[50] == ["Join us", "Story 0 is new", "Line 0"] and got[60] == ["Terms of use"]


def test_deep_and_stray_tags():
    deep = list(markup.blocks("<div class=c>" * 40_000 + "x" + "</div>" * 20_000 + "</p>" * 40_000 + "<p>y"))
    assert [b.text for b in deep] == ["x", "y"] and all(b.path.count("/") <= markup.DEPTH for b in deep)


def brute_importance(rows, least):
    """Content and style of each branch and place, from page to page in plain Python."""
    hosts = {}
    for _, url, body in rows:
        found = list(markup.blocks(body))
        sign = tuple((b.path, b.text) for b in found if not b.noise) or tuple((b.path, b.text) for b in found)
        # pages with the same sign are one; which blocks that are noise by name they show besides differs
        hosts.setdefault(re.sub("^http://|/.*$", "", url), {}).setdefault(sign, []).append(tuple((f"{b.path}#{min(sum(x.path == b.path for x in found[:i]), style_tree.SLOTS - 1)}", b.text) for i, b in enumerate(found)))
    out = {}
    for host, pages in hosts.items():
        above = lambda p: ["/".join(p.split("#")[0].split("/")[:k]) for k in range(2, p.count("/") + 2)] + [p]
        for branch in {a for shown in pages.values() for found in shown for p, _ in found for a in above(p)}:
            under = {s: [[(p, t) for p, t in found if branch in above(p)] for found in shown] for s, shown in pages.items()}
            under = {s: [u for u in many if u] for s, many in under.items() if any(many)}
            m = len(under)
            if m < least:
                continue
            shown = Counter(x for many in under.values() for x in {tuple(p.split("#")[0] for p, _ in u) for u in many})
            style = 0 if "#" in branch else -sum(k / m * math.log(k / m, m) for k in shown.values())
            leaves = Counter(x for many in under.values() for x in {(p, t) for u in many for p, t in u})
            weight = {x: k * len(x[1]) for x, k in leaves.items()}
            content = sum(max(0, 1 - math.log(k, m)) * weight[x] for x, k in leaves.items()) / sum(weight.values())
            out[host, branch] = (content, style)
    return out


def test_the_tree_alone_tells_menus_from_stories(spark):
    """Without names: menus, adverts and footers that pages share go, the article's paragraphs stay."""
    rng = random.Random(4)
    templates = [(f"<ul><li>{a}<li>{b}</ul>", f"<div class=x>Buy {a} now</div>", f"<div class=y>Made by {b}</div>") for a, b in (rng.sample("alpha beta gamma delta epsilon zeta".split(), 2) for _ in range(4))]
    rows = []
    for k in range(60):
        menu, advert, last = templates[k % 4]
        story = "".join(f"<p>Sentence {j} of story {k}" for j in range(k % 5 + 1))
        rows.append((k, f"http://h.example/{k}", page(f"{menu}{advert}<article><h1>Story {k}</h1>{story}</article>{last}")))
    got = {r["page_id"]: r["text"].split("\n") for r in style_tree.main_text(spark.createDataFrame(rows, SCHEMA), names=False).collect()}
    assert all(got[k] == [f"Story {k}", *(f"Sentence {j} of story {k}" for j in range(k % 5 + 1))] for k in range(60))


def test_small_hosts_keep_their_bodies(spark):
    body = lambda k: page(f"<article><p>Teaser {k}</p></article><div class=story>The body of page {k}, which is longer</div>")
    for n in (5, 12):
        df = spark.createDataFrame([(k, f"http://h.example/{k}", body(k)) for k in range(n)], SCHEMA)
        assert {r["text"] for r in style_tree.main_text(df).collect()} == {f"Teaser {k}\nThe body of page {k}, which is longer" for k in range(n)}


def test_hash_of_what_is_shown():
    def of(body):
        return style_tree.shown(list(markup.blocks(page(body))))

    a, b = of("<div><p>x<p>y</div><ul><li>1</ul>"), of("<div><p>other<p>words</div><ul><li>2</ul>")
    assert a == b and set(a) == {"/html", "/html/body", "/html/body/div", "/html/body/div/p", "/html/body/ul", "/html/body/ul/li"}
    c = of("<div><p>x</div><ul><li>1</ul>")
    assert c["/html/body/ul"] == a["/html/body/ul"] and c["/html/body/div"] != a["/html/body/div"] and c["/html"] != a["/html"]
    junk = "<div>x" * 200_000
    assert len(style_tree.shown(list(markup.blocks(junk)))) <= markup.DEPTH


def test_importance_is_that_of_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for k in range(90):
        parts = [f"<div class={rng.choice(['a', 'b', 'c'])}><p>{rng.choice(['same', 'text ' + str(rng.randrange(4)), 'own ' + str(k)])}</p>{'<ul><li>x<li>y</ul>' * rng.randrange(2)}</div>" for _ in range(rng.randrange(1, 5))]
        rows.append((k, f"http://h{k % 4}.example/{k}", page("".join(parts) + rng.choice(["", "<article><p>art</p></article>"]) + rng.choice(["", f"<nav><a>{rng.randrange(3)}</a></nav>"]))))
    got = {(r["host"], r["path"]): (r["content"], r["style"]) for r in style_tree.importance(spark.createDataFrame(rows, SCHEMA), least_pages=3).collect()}
    want = brute_importance(rows, 3)
    assert set(got) == set(want) and len(got) > 20
    assert all(abs(a - b) < 1e-9 for k in got for a, b in zip(got[k], want[k]))


def test_warc(spark):
    rows = [(1, "http://a.example/x y\r\nz", "<title>T</title><p>é &amp; ü</p><a href='/l'>l</a>"), (2, None, None), (3, "", ""), (1, "http://a.example/x y\r\nz", "<title>T</title><p>é &amp; ü</p><a href='/l'>l</a>"), (None, "u", "<p>" + "x" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("record", F.lit(0))
    responses = warc.responses(df)
    ids = {r["record_id"]: r for r in warc.index(responses).collect()}
    found = warc.linked(warc.derivatives(responses)).collect()
    assert len(found) == 2 * len(rows) and all(r["digest_holds"] and r["refers_to"] in ids for r in found)
    assert {r["type"] for r in found} == {"metadata", "conversion"}
    source = warc.response(*rows[0])
    conversion, metadata = map(warc.parse, warc.derive(source))
    assert conversion[1].decode() == "é & ü\nl" or conversion[1].decode() == "é & ü l" or "é & ü" in conversion[1].decode()
    headers = warc.parse(source)[0]
    assert metadata[0]["WARC-Refers-To"] == headers["WARC-Record-ID"] == conversion[0]["WARC-Refers-To"]
    assert f"source-WARC-Payload-Digest: {headers['WARC-Payload-Digest']}" in metadata[1].decode() and "outlink: /l" in metadata[1].decode()
    assert warc.derive(warc.derive(source)[0]) == [] and warc.linked(warc.derivatives(warc.responses(df.limit(0)))).count() == 0


def test_odd_records():
    body = "<p>größer</p>".encode("latin-1")
    sent = b"HTTP/1.1 200 OK\r\ncontent-type: text/html; charset=ISO-8859-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    packed = gzip.compress(body)
    sent += b"%x\r\n" % 5 + packed[:5] + b"\r\n%x;x=y\r\n" % (len(packed) - 5) + packed[5:] + b"\r\n0\r\n\r\n"
    record = b"WARC/1.0\r\nwarc-type: response\r\nWARC-RECORD-ID: <urn:x>\r\nX-Long: a\r\n b\r\nContent-Length: %d\r\n\r\n" % len(sent) + sent + b"\r\n\r\n"
    conversion, metadata = map(warc.parse, warc.derive(record))
    assert conversion[1].decode() == "größer" and metadata[0]["WARC-Refers-To"] == "<urn:x>"
    for odd in (b"", b"WARC/9\r\n\r\n", b"junk", record[:-40], b"WARC/1.1\r\nContent-Length: x\r\n\r\n"):
        assert warc.derive(odd) == []


def made(name, block=b"hello", version=b"WARC/1.1", length=None, more=b""):
    return version + b"\r\nWARC-Type: resource\r\nwarc-record-id: <urn:%s>\r\n%sContent-Length: %d\r\n\r\n" % (name, more, len(block) if length is None else length) + block + b"\r\n\r\n"


def told(data, step):
    """Names of the readable records and how many stretches cannot be read, with the file coming in pieces of step bytes."""
    records = [warc._parsed(x) for x in warc.split(data[i : i + step] for i in range(0, len(data), step))]
    return [r[0]["WARC-Record-ID"][5:-1] for r in records if r], sum(r is None for r in records)


@pytest.mark.parametrize("step", [1, 7, 1000, 1 << 20])
def test_what_cannot_be_read_ends_at_the_next_record(step):
    good = [made(b"%d" % k, b"block %d \r\nWARC is no record here\r\n" % k) for k in range(4)]
    odd = [made(b"x", version=b"WARC/0.18"), b"junk\r\nmore junk\r\n", made(b"x", length=10_000), made(b"x").replace(b"Content-Length", b"Content-Lost")]
    for bad in odd:
        data = good[0] + good[1] + bad + good[2] + good[3]
        assert told(data, step) == (["0", "1", "2", "3"], 1)
        members = b"".join(map(gzip.compress, [good[0], good[1], bad, good[2], good[3]]))
        assert told(members, step) == (["0", "1", "2", "3"], 1)
    broken = bytearray(gzip.compress(good[1] * 50))
    broken[len(broken) // 2 :] = b"\x00" * 9
    names, lost = told(gzip.compress(good[0]) + bytes(broken) + gzip.compress(good[2]), step)
    assert names[0] == "0" and names[-1] == "2"
    assert told(good[0] + good[1][:-30], step) == (["0"], 1) and told(b"", step) == ([], 0) and told(gzip.compress(good[0])[:-9], step)[1] <= 1


def test_headers_stay_as_sent():
    data = made(b"a", more=b"WARC-Concurrent-To: <urn:1>\r\nWARC-Concurrent-To: <urn:2>\r\nX-Case: Kept\r\n")
    (back,) = warc.split(iter([data]))
    assert back == data
    headers, _ = warc.parse(back)
    assert headers.every("warc-concurrent-to") == ["<urn:1>", "<urn:2>"] and ("X-Case", "Kept") in headers.fields


def test_bodies_in_codings():
    import time

    import zstandard

    head = lambda coding: warc.Headers([b"Content-Encoding: " + coding])
    two = gzip.compress(b"first ") + gzip.compress(b"second")
    assert warc.body_of(head(b"gzip"), two) == ("first second", "")
    assert warc.body_of(head(b"gzip, gzip"), gzip.compress(two)) == ("first second", "")
    assert warc.body_of(head(b"identity"), b"plain") == ("plain", "") and warc.body_of(head(b"gzip"), b"plain") == ("plain", "")
    assert warc.body_of(head(b"zstd, deflate"), zlib.compress(zstandard.compress(b"text"))) == ("text", "")
    assert warc.body_of(head(b"gzip, br"), b"\x0b\x02") == ("", "gzip, br")
    chunked = warc.Headers([b"Transfer-Encoding: chunked"])
    began = time.perf_counter()
    assert warc.body_of(chunked, b"1\r\nx\r\n" * 400_000 + b"0\r\n\r\n")[0] == "x" * 400_000
    assert time.perf_counter() - began < 5


def test_large_files_are_streamed(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(made(b"%d" % k)) for k in range(30)))
    (tmp_path / "b.warc").write_bytes(b"".join(made(b"b%d" % k) for k in range(5)))
    both = [sorted(r["record_id"] for r in warc.index(warc.read(spark, f"file://{tmp_path}", whole=n)).collect()) for n in (0, 1 << 20)]
    assert both[0] == both[1] and len(both[0]) == 35


def test_warc_files(spark, tmp_path):
    rows = [(k, f"http://a.example/{k}", f"<p>text {k}</p>" * (k % 3)) for k in range(40)] + [(40, None, None)]
    derived = warc.derivatives(warc.responses(spark.createDataFrame(rows, SCHEMA).repartition(3))).persist()
    written = warc.write(derived, f"file://{tmp_path}/out").collect()
    assert sum(r["n_records"] for r in written) == 82
    # an independent reader: members by gzip, headers as mail headers
    seen = Counter()
    for r in written:
        data = gzip.decompress((tmp_path / "out" / r["name"]).read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            version, _, fields = head.partition(b"\r\n")
            n = int(email.message_from_bytes(fields)["Content-Length"])
            assert version == b"WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n"
            block = rest[:n]
            assert email.message_from_bytes(fields)["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            seen[email.message_from_bytes(fields)["WARC-Record-ID"]] += 1
            data = rest[n + 4 :]
    back = warc.index(warc.read(spark, f"file://{tmp_path}/out"))
    assert Counter(r["record_id"] for r in back.collect()) == seen and back.where("NOT digest_holds").count() == 0
    assert warc.index(spark.createDataFrame([(1, b"junk")], "page_id long, record binary")).first()["type"] == ""

import gzip
import hashlib
import random

import duckdb

from hazeline.llm import dom, q_pages, warc
from hazeline.llm.dom import matched, parse
from hazeline.llm.extraction import extract, induce, main_text
from hazeline.session import scratch_path

PAGES = "page_id long, url string, html string, key string, digest string, text string, template string, host string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], PAGES)


def odd_pages():
    big = "<p>" + "x" * 1200 + "</p>"
    return [(1, "http://a.example/1", big), (2, "http://a.example/2", big), (3, None, big), (4, "http://a.example/é \r\nX: y", "small"), (5, "u", "small"), (6, "u", None),
            (7, "u", ""), (None, "n", big), (8, "u", big + "\r\n\r\nWARC/1.1\r\n\r\n"), (9, "u", big + "\r\n\r\nWARC/1.1\r\n\r\n"), (2, "http://a.example/2", big),
            (10, "u", "é" * 499 + "a"), (11, "u", "é" * 499 + "a"), (12, "u", "é" * 500), (13, "u", "é" * 500), (14, "u", "long " * 300_000), (15, "u", None)]


def brute_records(rows):
    last, out = {}, []
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and last.get(h or "") is not None and i != last[h or ""]
        out.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", str(last[h or ""]) if again else "None"))
    return sorted(out)


def test_archives(spark):
    rows = odd_pages()
    got = warc.archive(pages_of(spark, rows), "page_id", "url", "html").collect()
    assert sorted((str(r.key), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == brute_records(rows)
    assert sorted(r.uri for r in got) == sorted(u or "" for _, u, _ in rows)
    assert warc.archive(pages_of(spark, rows).where("false"), "page_id", "url", "html").collect() == []


def test_files_are_archives(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages_of(spark, odd_pages()), path, "page_id", "url", "html")
    files = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()]
    records = [r for f in files for r in warc.parsed(gzip.decompress(f))]
    assert len(records) == len(odd_pages())
    full = {h["warc-record-id"]: b for h, b in records if h["warc-type"] == "response"}
    for head, block in records:
        assert block.startswith(b"HTTP/1.1 200 OK\r\n")
        if head["warc-type"] == "revisit":
            assert head["warc-refers-to"] in full and block.endswith(b"\r\n\r\n")


def test_archive_query_equals_its_check(spark):
    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.01/pages.parquet'")
    got = sorted(map(str, map(tuple, q_pages.op8_warc(spark, "/root/testdata/sf0.01").collect())))
    assert got == sorted(map(str, con.execute(q_pages.ARCHIVED).fetchall()))


def page(i, words):
    return (f"<html><head><title>{i}</title><style>p{{}}</style></head><body><header class=top>Site {i}</header><div id=wrap><div class=x1><p>{words} &amp; more"
            f"<div>Same line on each page</div><p>{words * 3}<br>and <b>bo</b>ld</div><div class='sidebar'>{words[::-1]}</div></div>"
            f"<div class=cookie-notice>We use {i}</div><form>search {i}</form><div class='comments'><p>I like {words}</div><script>'</p>'</script></body></html>")


def test_slots_and_templates_without_an_article():
    pages = [page(i, f"{c * 7} words ") for i, c in enumerate("abcdefgh")]
    keys, slot = induce(pages)
    assert slot == "html/div.wrap/div.x1"
    assert main_text(pages[2], frozenset(keys), slot) == "ccccccc words & more ccccccc words ccccccc words ccccccc words and bold"
    assert induce(pages[:3]) == ([], None) and induce([pages[0]] * 20) == ([], None)


def test_articles():
    assert main_text("<body><nav>menu</nav><article class=post><header><h1>A &lt;b&gt;</h1></header><p>x\n y<p>z</article><footer>f</footer>") == "A <b> x y z"
    assert main_text("<article>a<aside>no</aside><div class='share-buttons'>no</div><ul><li>b<li>c</ul><table><tr><td>d<td>e</table></article>") == "a b c d e"
    assert main_text("<main><p>kept</p><section id=comments><article class=comment>no</article></section></main>") == "kept"


def test_nothing_of_the_article_is_dropped():
    assert main_text("<article><p>one two</p></article><div class=ad>no</div><article><p>three four five</p></article>") == "one two three four five"
    assert main_text("<article><p class='share-price'>4.20</p><div class='related-work'>kept</div><div class='related-posts'>no</div><p class='ad'>no</p></article>") == "4.20 kept"
    assert main_text("<div class='page-header'>no</div><h2><a href=x>A linked heading</a></h2><p>Text of the page.</p><p><a href=y>only a link</a></p>") == "A linked heading Text of the page."


def test_broken_and_plain_pages():
    assert main_text(None) == main_text("") == main_text("<!-- only -->") == main_text("<script>x") == ""
    assert main_text("just <b>te</b>xt a < b &lt; <i>x") == "just text a < b < x"
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert main_text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()


def test_matching_keeps_order():
    a, b = parse("<ul><li>1<li>2<li>3</ul>"), parse("<ul><li>2<li>3<li>4<li>1</ul>")
    assert [(x.text, y.text) for x, y in matched(a, b) if x.tag == "li" and x.text == y.text] == [("2", "2"), ("3", "3")]


def test_long_lists_are_aligned_in_full(monkeypatch):
    items = [f"<p>text {i}</p>" for i in range(400)]
    a, b = parse("<div>" + "".join(items) + "</div>"), parse("<div>" + "".join(["<p>other</p>", *items[:3], "<p>new</p>", *items[3:200], *items[205:]]) + "</div>")
    assert sum(x.text == y.text for x, y in matched(a, b) if x.tag == "p") == 395
    # halved or in one table, the score is the same
    rng = random.Random(6)
    for _ in range(30):
        one, other = (parse("".join(rng.choice(["<p>a", "<p>b", "<div><p>c</p><p>d</p></div>", "<div><p>c</p></div>", "<ul><li>e</ul>"]) for _ in range(rng.randint(0, 14)))) for _ in range(2))
        scores = []
        for most in (40_000, 4, 0):
            monkeypatch.setattr(dom, "MOST_PAIRS", most)
            pairs = matched(one, other)
            scores.append((dom._score(one, other, {}, None, False), sum(1 + (x.text == y.text) for x, y in pairs)))
        assert scores[0][0] == scores[0][1] and len(set(scores)) == 1


def test_pages_of_all_kinds(spark):
    rng = random.Random(3)
    body = lambda i: "<nav>x</nav><article><p>" + " ".join(rng.choice("abcdef") * 3 for _ in range(20)) + f"{i}</p></article>"
    rows = [(i, f"https://user@Host.example:80/{i}", body(i)) for i in range(12)] + [(20, None, body(20)), (21, "no host", body(21)), (22, "http://h/", None), (None, "http://h/", ""), (0, "https://host.example/0", body(0))]
    got = extract(pages_of(spark, rows)).collect()
    want = [(i, u, main_text(h)) for i, u, h in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert extract(pages_of(spark, rows).where("false")).collect() == []


def test_templates_from_all_pages_of_a_host(spark):
    """Two layouts of one host, one with a ninth of the pages, without articles; the constants are on all pages of a layout."""
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60))
    rows, want = [], []
    for i in range(200):
        body, kept = f"<p>{text()}</p><p>{text()}</p>", i % 10
        html = f"<div class=top1>Read the daily paper</div><div class=c1>{body}</div>" if kept else f"<div class=x><div class=c2>{body}</div><div class=end2>All about us</div></div>"
        rows.append((i, f"http://host.example/{i}", html))
        want.append(main_text(body))
    got = {r.page_id: r.text for r in extract(pages_of(spark, rows)).collect()}
    assert [got[i] for i in range(200)] == want


def test_notices_of_most_pages_are_template(spark):
    """A notice on nine of ten pages of each host goes, whichever pages have it; one on half of them stays."""
    for share, stays in ((10, False), (2, True)):
        rows = [(i, "http://host.example/", f"<div class=c><p>{'word ' * 20}{i}</p>" + ("<p>Our office has moved</p>" if i % share or share == 2 and i % 4 == 1 else "") + "</div>") for i in range(60)]
        got = [r.text for r in extract(pages_of(spark, rows)).collect()]
        assert any("office" in t for t in got) == stays and all("word" in t for t in got)


def test_extraction_query(spark):
    rows = {r.page_id: r for r in q_pages.op7_extraction(spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert rows.keys() == {p.page_id for p in pages}
    for p in pages:
        inside = p.html.split("<article>")[1].split("</article>")[0]
        assert rows[p.page_id].text == main_text(f"<article>{inside}</article>") and rows[p.page_id].n_chars == len(rows[p.page_id].text)

"""URL equivalence, HTML extraction and WARC transactions."""

import base64
import glob
import gzip
import hashlib
import math
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanscore.llm import html_density, url_equivalence, warc_transactions
from loanscore.llm.common import Written
from loanscore.llm.queries import URL_RULES

# URL equivalence


def judge(spark, urls, edges=()):
    frame = spark.createDataFrame([(i, u, "h", "n") for i, u in enumerate(urls)], "page_id long, url string, HOST string, node string")
    links = spark.createDataFrame(list(edges), "src string, dst string")
    out = url_equivalence.judge_urls(frame, links, URL_RULES)
    assert [c.lower() for c in out.columns].count("host") == 1 and "node" in out.columns
    return [(r.host, r.path, r.rule, r.verdict) for r in out.orderBy("page_id").collect()]


def test_rules(spark):
    assert judge(
        spark,
        [
            "http://WWW.Example.ORG/es/1?q#f", "http://example.org/en/123", "http://example.org/en/2", "http://notexample.org/es/1",
            "http://x.com/de/", "https://x.com/fr/a#b", "http://x.com/De/", "http://x.net/", None, "", "no scheme", "http://org", "a://b://c/d",
            "http://com/de/x?://org/",
        ],
    ) == [
        ("www.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/123", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("notexample.org", "/es/1", "org/", "allow"), ("x.com", "/de/", "com/de/", "block"),
        ("x.com", "/fr/a", "com/fr/", "allow"), ("x.com", "/De/", None, "allow"), ("x.net", "/", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("org", "", None, "allow"), ("b:", "//c/d", None, "allow"),
        ("com", "/de/x", "com/de/", "block"),
    ]


def test_blocks_reach_aliases_and_allows_come_first(spark):
    urls = ["http://a.net/1", "http://b.net/1#x", "http://c.net/1", "http://d.net/1", "http://x.com/de/1", "http://e.net/"]
    edges = [("http://a.net/1", "http://B.net/1"), ("http://b.net/1", "http://x.com/de/1"), ("http://c.net/1", "http://y.com/de/1"),
             ("http://d.net/1", "http://c.net/1"), ("http://d.net/1", "http://z.org/"), (None, "http://e.net/"), ("x", "y")]
    verdicts = [v for *_, v in judge(spark, urls, edges)]
    assert verdicts == ["block", "block", "allow", "allow", "block", "allow"]


def test_long_chains_and_repeated_rows(spark):
    chain = [(f"http://n{i}.net/", f"http://n{i + 1}.net/") for i in range(60)] + [("http://n60.net/", "http://x.com/de/")]
    assert {v for *_, v in judge(spark, ["http://n0.net/", "http://n0.net/", "http://n31.net/"], chain * 2)} == {"block"}


def test_edges_from_html(spark):
    pages = spark.createDataFrame(
        [
            ("http://a.com/x/y?q", '<LINK href="http://b.com/" rel=canonical><p>'),
            ("http://a.com/x/y?q", "<link rel='canonical' href='/z?a=1&amp;b'>"),
            ("http://a.com/x/y", '<meta http-equiv="refresh" content="0; URL=w.html">'),
            ("https://a.com", "<link rel=canonical href=//c.com/d>"),
            ("http://a.com", "<p>rel=canonical text</p>"), ("http://a.com", None), (None, "<link rel=canonical href=/x>"),
        ],
        "url string, html string",
    )
    got = {(r.src, r.dst) for r in url_equivalence.link_edges(pages).where("dst IS NOT NULL").collect()}
    assert got == {
        ("http://a.com/x/y?q", "http://b.com/"), ("http://a.com/x/y?q", "http://a.com/z?a=1&b"),
        ("http://a.com/x/y", "http://a.com/x/w.html"), ("https://a.com", "https://c.com/d"),
    }


def test_no_urls(spark):
    assert judge(spark, []) == []


# HTML extraction

ARTICLE = "".join(f"<p>Paragraph {i} with <b>some</b> words in it, enough to count as text.</p>" for i in range(6))
EXPECTED = "\n".join(f"Paragraph {i} with some words in it, enough to count as text." for i in range(6))
NOISE = '<ul>' + "".join(f'<li><a href="/{i}">Menu entry number {i}</a></li>' for i in range(12)) + "</ul>"

PAGES = [
    (f"<body><nav>{NOISE}</nav><article><h1>Title</h1>{ARTICLE}</article><footer>foot words</footer></body>", "Title\n" + EXPECTED),
    (f"<html><head><title>T</title></head><body><div>{NOISE}</div><div class='post'><h1>Title</h1><div>{ARTICLE}</div></div><div>{NOISE}</div>", "Title\n" + EXPECTED),
    (f"<div id=sidebar>{ARTICLE}</div><div class='entry'>{ARTICLE}</div><div class='comments'>{ARTICLE}{ARTICLE}</div>", EXPECTED),
    (f"<article>{ARTICLE}<section class='comment-list'><article class=comment><p>nice text of a reader, quite long indeed</p></article></section></article>", EXPECTED),
    (f"<article>{ARTICLE}<div class='cookie-notice'>We use</div><div class=ad>Buy</div><form><label>Mail</label></form><aside>x</aside></article>", EXPECTED),
    ("<article><p>a &amp; b &lt;c&gt; &eacute;&nbsp;d&#33;\n\t e<br>f<p>g</article>", "a & b <c> \u00e9 d! e f\ng"),
    ("<article><p>unclosed <b>bold<br><p>next &am", "unclosed bold\nnext &am"),
    ('<article><script>var t="</p><p>no";</script><style>p{}</style><!-- <p>no</p> --><p>yes 1 < 2</article>', "yes 1 < 2"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\ntwo\nc1\nc2"),
    ("<article></article><p>other words outside</p>", "other words outside"),
    ("<p>Only one paragraph of text here.</p>", "Only one paragraph of text here."),
    ("plain words", "plain words"),
    ("", ""),
    (None, ""),
    ("<", "<"),
    ("<p", ""),
    ("</p></div>", ""),
    ("<article><p>" + "long " * 100_000 + "</p></article>", ("long " * 100_000).strip()),
    ("<div>" * 3000 + "<p>deep</p>", "deep"),
]


@pytest.mark.parametrize("html, text", PAGES, ids=range(len(PAGES)))
def test_main_text(html, text):
    assert html_density.main_text(html or "") == text


SHORT = "".join(f"<p>Short {i} it is.</p>" for i in range(4))
SHORT_TEXT = "\n".join(f"Short {i} it is." for i in range(4))

DECLARED = [
    (f"<body><article>{ARTICLE}</article><article>{SHORT}</article></body>", EXPECTED + "\n" + SHORT_TEXT),  # split in two
    (f"<body><div><article>{SHORT}</article></div><div>{NOISE}</div><article>{ARTICLE}</article></body>", SHORT_TEXT + "\n" + EXPECTED),
    (f"<body><article><a href=/t>Teaser of it</a></article><div>{ARTICLE}</div></body>", EXPECTED),  # the text stands outside
    (f"<body><article></article><article>{ARTICLE}</article></body>", EXPECTED),
    (f"<body><article><section>{ARTICLE}</section><section>{SHORT}</section></article><div>{NOISE}</div></body>", EXPECTED + "\n" + SHORT_TEXT),
    ("<body><article></article><p>words</p></body>", "words"),
    (f"<body><main></main><div>{NOISE}</div><div class=post>{ARTICLE}</div></body>", EXPECTED),
]


@pytest.mark.parametrize("html, text", DECLARED, ids=range(len(DECLARED)))
def test_density_decides_on_pages_with_articles(html, text):
    assert html_density.main_text(html) == text


NESTED = ["<div>", "<li>", "<article>", "<div><li>", "<p><b>", "<td>", "</div>", "<header>"]


@pytest.mark.parametrize("tags", NESTED)
def test_time_grows_with_length_however_deep(tags):
    def seconds(n):
        start = time.process_time()
        text = html_density.main_text(tags * n + "<p>some words")
        assert text == ("" if tags == "<header>" else "some words")
        return time.process_time() - start

    short, long = seconds(5_000), seconds(50_000)
    assert long < 30 * max(short, 0.05)  # 100 times if it grew with the square


def slow_densities(node):
    """(chars, tags, link chars, links) of a subtree counted anew for every element, and the kept elements in it."""
    text, tags, linked, links, kept = "", 0, "", 0, [node]

    def walk(at, in_link):
        nonlocal text, tags, linked, links
        for child in at.children:
            if isinstance(child, str):
                text += "".join(child.split())
                linked += "".join(child.split()) if in_link else ""
            elif not child.dropped:
                tags += 1
                links += child.tag == "a"
                kept.append(child)
                walk(child, in_link or child.tag == "a")

    links += node.tag == "a"
    walk(node, node.tag == "a")
    return (len(text), tags, len(linked), links), kept


def slow_core(root):
    """The element of the largest density sum, every count and density made from its own walk."""
    (body_chars, _, body_linked, _), kept = slow_densities(root)

    def density(node):
        (chars, tags, linked, links), _ = slow_densities(node)
        if not chars:
            return 0.0
        tags, linked, links = max(tags, 1), max(linked, 1), max(links, 1)
        base = math.log(linked * chars / max(chars - linked, 1) + body_linked / max(body_chars, 1) * chars + math.e)
        return chars / tags * max(math.log(chars * tags / (linked * links)), 0.0) / math.log(base)

    def total(node):
        return sum(density(c) for c in node.children if not isinstance(c, str) and not c.dropped)

    sums = {id(n): (total(n), density(n)) for n in kept}
    return max(sums.values()), sums


def test_densities_equal_a_second_computation():
    pages = [h for h, _ in PAGES + DECLARED if h and len(h) < 10_000]
    pages += [row["html"] or "" for row in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()]
    for html in pages:
        root = html_density.parse(html)
        order = html_density._postorder(root)
        html_density._measure(order)
        best, sums = slow_core(root)
        assert len(sums) == len(order)
        for node in order:
            assert (html_density._density_sum(node), node.density) == pytest.approx(sums[id(node)])
        core = max(order, key=lambda n: (html_density._density_sum(n), n.density))
        assert sums[id(core)] == pytest.approx(best)


def test_extract(spark):
    rows = [(n, None if n == 2 else f"u{n}", h, "old", "t") for n, (h, _) in enumerate(PAGES)] * 2
    out = html_density.extract(spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string, row string"))
    assert [c.lower() for c in out.columns].count("text") == 1
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == PAGES[r.page_id][1] and r.n_chars == len(r.text)
    assert html_density.extract(out.where("false")).collect() == []


def test_density_prefers_text_to_links():
    root = html_density.parse(f"<body><div>{NOISE}</div><div>{ARTICLE}</div></body>")
    html_density._measure(html_density._postorder(root))
    links, text = root.children[0].children
    assert text.density > links.density


# WARC


def sha1(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


CAPTURES = [
    (3, "http://a.org/x y", "same"), (1, "http://b.org", "same"), (7, None, "same"), (2, "http://c.org/\r\nWARC/1.1", "WARC/1.1\r\nWARC-Type: x\r\n\r\nbody\r\n\r\n"),
    (4, "u", None), (5, "u", ""), (6, "u", "\u00e9\U0001f600\r\n\r\n\r\n"), (8, "u", "z" * 3_000_000), (9, "u", "twice"), (9, "u", "twice"), (None, "u", "none"), (None, "u", "same"),
]


def round_trip(spark, tmp_path, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "capture_id long, url string, payload string, record string, seed string")
    path = str(tmp_path / "archives")
    warc_transactions.write_archives(frame, path, **options)
    block = F.col("block")
    payload = warc_transactions.payload_of(block)
    return warc_transactions.assemble(
        warc_transactions.read_records(spark, path),
        main=[payload.alias("payload"), F.col("payload_digest").alias("digest"), F.col("refers_to").cast("long").alias("refers_to")],
        request=[block.alias("block")],
        metadata=[warc_transactions.field_of(block, "captureId").alias("id"), warc_transactions.field_of(block, "payloadBytes").alias("n")],
    )


def test_round_trip(spark, tmp_path):
    out = round_trip(spark, tmp_path, CAPTURES).collect()
    assert len(out) == len(CAPTURES)
    first = {"same": 1, "": 4, "twice": 9}
    got = sorted((r.metadata[0].id, r.main.warc_type, r.main.refers_to, r.main.digest, r.metadata[0].n) for r in out)
    expected = []
    for i, _, payload in CAPTURES:
        payload = payload or ""
        target = first.get(payload)
        revisit = target is not None and target != i
        expected.append(("" if i is None else str(i), "revisit" if revisit else "response", target if revisit else None, "sha1:" + sha1(payload), str(len(payload.encode()))))
    assert got == sorted(expected, key=lambda x: (x[0], x[1], x[2] or 0))
    for r in out:
        assert len(r.requests) == len(r.metadata) == 1 and r.requests[0].block.startswith(b"GET ")
        if r.main.warc_type == "response":
            assert "sha1:" + base64.b32encode(hashlib.sha1(bytes(r.main.payload)).digest()).decode() == r.main.digest
        else:
            assert bytes(r.main.payload) == b""


def test_least_bytes_and_small_files(spark, tmp_path):
    out = round_trip(spark, tmp_path, CAPTURES, min_bytes=5, bytes_per_file=1).collect()
    kinds = {(r.metadata[0].id, r.main.warc_type) for r in out}
    assert ("3", "response") in kinds and ("5", "response") in kinds and len(out) == len(CAPTURES)


def test_files_are_bounded_with_uneven_sizes(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"{i} " + "x" * (60_000 if i > 180 else 100)) for i in range(200)] + [(500, "u", "y" * 500_000)]
    out = round_trip(spark, tmp_path, rows, bytes_per_file=200_000).collect()
    assert len(out) == len(rows)
    sizes = []
    for file in glob.glob(str(tmp_path / "archives" / "**" / "*.gz"), recursive=True):
        with gzip.open(file) as data:
            found = data.read()
        sizes.append((len(found), len(list(warc_transactions.parse_records(found)))))
    assert sum(n for _, n in sizes) == 3 * len(rows)
    assert all(size <= 200_000 or n == 1 for size, n in sizes)
    assert max(size for size, _ in sizes) > 500_000 and len(sizes) < 40


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def test_captures_of_a_frequent_payload_are_split(spark):
    old = {key: spark.conf.get(key, None) for key in SKEWED}
    shared = None
    try:
        for key, value in SKEWED.items():
            spark.conf.set(key, value)
        digits = F.sha2(F.col("id").cast("string"), 512)
        payload = F.when(F.col("id") % 2 == 0, F.lit("error page")).otherwise(digits)
        captures = spark.range(0, 8000, 1, 16).select(F.col("id").alias("capture_id"), digits.alias("url"), payload.alias("payload"))
        keyed = warc_transactions.keyed_captures(captures)
        shared = Written(warc_transactions.shared_payloads(keyed), "shared_payloads")
        marked = warc_transactions.mark_revisits(keyed, shared.df)
        rows = marked.collect()
        assert {(r.capture_id % 2, r.refers_to) for r in rows if r.capture_id} == {(0, 0), (1, None)} and len(rows) == 8000
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        if shared:
            shared.drop()
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_no_captures(spark, tmp_path):
    assert round_trip(spark, tmp_path, []).collect() == []


def test_records_are_cut_by_length_in_any_gzip_form():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nab\r\n\r\ncde\r\n\r\n"
    for data in (record * 3, gzip.compress(record * 3), gzip.compress(record) * 3):
        assert [b for _, _, b in warc_transactions.parse_records(data)] == [b"ab\r\n\r\ncde"] * 3
    assert [b for _, _, b in warc_transactions.parse_records(gzip.compress(record * 500)[:-9])][0] == b"ab\r\n\r\ncde"


def test_base32(spark):
    rows = spark.createDataFrame([("",), ("a",), ("\u00e9" * 99,)], "t string").select("t", warc_transactions.sha1_base32(F.col("t")).alias("d"))
    assert all(r.d == sha1(r.t) for r in rows.collect())


def test_cut_archive_gzipped_by_record_keeps_its_whole_records():
    def record(i):
        block = hashlib.sha512(b"%d" % i).hexdigest().encode() * (3000 if i == 2 else 1)
        return b"WARC/1.1\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(block)) + block + b"\r\n\r\n"

    data = b"".join(gzip.compress(record(i)) for i in range(5))
    whole = list(warc_transactions.parse_records(data))
    found = list(warc_transactions.parse_records(data[:-20]))
    assert len(whole) == 5 and found[:4] == whole[:4]
    assert list(warc_transactions.parse_records(data[: len(data) - len(gzip.compress(record(4))) + 5])) == whole[:4]


def test_payload_after_a_long_head(spark):
    heads = [b"HTTP/1.1 200 OK\r\nX: " + b"x" * n + b"\r\n\r\n" for n in (10, 65_530, 200_000)]
    frame = spark.createDataFrame([(i, bytearray(h + b"body\r\n\r\nmore")) for i, h in enumerate(heads)] + [(3, bytearray(b"no head"))], "i int, block binary")
    got = {r.i: bytes(r.p) for r in frame.select("i", warc_transactions.payload_of(F.col("block")).alias("p")).collect()}
    assert got == {0: b"body\r\n\r\nmore", 1: b"body\r\n\r\nmore", 2: b"body\r\n\r\nmore", 3: b""}


def test_payload_is_cut_by_bytes_without_decoding_the_block(spark):
    blocks = [b"\r\n\r\nfirst", b"X: \xe4\xbd\r\n\r\n\xff\r\n\r\nx", b"ends\r\n\r\n", "Ä: ü\r\n\r\nö".encode(), b"\r\n\r", b""]
    frame = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blocks)], "i int, block binary")
    cut = frame.select("i", warc_transactions.payload_of(F.col("block")).alias("p"))
    assert "decode" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert [bytes(r.p) for r in cut.orderBy("i").collect()] == [b.partition(b"\r\n\r\n")[2] for b in blocks]

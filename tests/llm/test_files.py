import base64
import hashlib
import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from frames import *  # noqa: F403
from tallyloom.llm import reshard, warc
from tallyloom.llm.html_text import blocks, extract_text, labels, main_text


@pytest.fixture(scope="module")
def pages(spark):
    random.seed(3)
    large = "".join(random.choices("abcdefgh<>/é", k=400_000))
    htmls = [None, "", "same", "same", "same", "other", large, "\x1f WARC/1.0\r\n\r\n", "<p>é漢</p>" * 50, large]
    rows = [(i, f"http://a/{i}\r\nX: y" if i == 5 else f"http://a/{i}", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame([*rows, (4, "http://a/4", "same"), (None, None, "same")], "page_id long, url string, html string")


def expected(rows, min_bytes=0):
    first = {}
    for r in rows:
        h = r["html"] or ""
        if r["page_id"] is not None and len(h.encode()) >= min_bytes:
            first[h] = max(first.get(h, -1), r["page_id"])
    for r in rows:
        data = (r["html"] or "").encode()
        to = first.get(r["html"] or "", r["page_id"])
        to = None if to == r["page_id"] else to
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield r["page_id"], len(data), digest, "response" if to is None else "revisit", to


@pytest.mark.parametrize("split", [97, 5000, 16 << 20])
def test_archives_come_back_whole(spark, pages, tmp_path, split):
    path = str(tmp_path / "warc")
    warc.write_archives(pages.repartition(3), path)
    rows = warc.read_archives(spark, path, split_bytes=split).collect()
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=str) == sorted(expected(pages.collect()), key=str)
    texts = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    assert all(r["payload"].decode() == texts[r["page_id"]] for r in rows if r["record_type"] == "response")
    assert {r["url"] for r in rows if r["page_id"] == 5} == {"http://a/5%0D%0AX: y"}


def test_small_payloads_are_responses_and_empty_tables(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "a"), min_bytes=5)
    got = warc.read_archives(spark, str(tmp_path / "a"), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(pages.collect(), 5), key=str)
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_a_large_record_ends_in_a_zero_byte(spark, tmp_path):
    page = spark.range(2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat('ab', 9000000 + int(id))").alias("html"))
    warc.write_archives(page, str(tmp_path / "w"))
    rows = warc.read_archives(spark, str(tmp_path / "w"), ["page_id", "payload_bytes"], split_bytes=10_000).collect()
    assert sorted(map(tuple, rows)) == [(0, 18_000_000), (1, 18_000_002)]


def test_damaged_records_are_refused():
    data = warc.record(1, "u", "text", None)
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"text\r\n", b"tent\r\n"))


ARTICLE = (
    "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav>"
    "<!-- ad --><div class='ad'>Buy the best of all</div><article><h1>Title &amp; more</h1><p><b>First\n line<br><p>Second</p>"
    "<div class=\"comments\"><p>I like it</p></div></article><aside>side</aside><footer>&copy; x</footer>"
)


def test_article_text():
    assert main_text(ARTICLE) == "Title & more\n\nFirst line\n\nSecond"
    assert main_text(ARTICLE[:ARTICLE.index("Second") + 4]) == "Title & more\n\nFirst line\n\nSeco"
    assert main_text(None) == main_text("") == main_text("<p> </p>") == ""


def test_blocks_without_an_article():
    html = (
        "<div id='menu'><a href=x>Home</a> | <a href=y>About</a></div><h2>A heading</h2>"
        "<div>The cat sat on the mat and it was in the house with the dog.</div><p>Short one.</p>"
        "<form>Name <input></form><p>&copy; 2020</p>"
    )
    page = blocks(html)
    assert [b.text for b, good in zip(page, labels(page), strict=True) if good] == [
        "A heading", "The cat sat on the mat and it was in the house with the dog.", "Short one.",
    ]


PROSE = "the cat sat on the mat and it was in the house with the dog " * 3


def test_text_outside_the_article_element():
    rest = f"<h2>More</h2><p>{PROSE}</p><p>Short one.</p>"
    html = f"<nav>Home</nav><p>By me</p><article><p>A teaser.</p></article>{rest}<footer>&copy; x</footer>"
    assert main_text(html).split("\n\n") == ["A teaser.", "More", PROSE.strip(), "Short one."]


def test_blocks_inside_the_article_are_judged():
    links = "<p><a href=x>one</a> <a href=y>two</a></p>"
    spam = "<p>" + "buy cheap shoes " * 12 + "</p>"
    html = f"<article><div class='ad'>Buy</div><h1>Title</h1><div class='share'>Share</div><p>{PROSE}</p>"
    html += f"{links}<p>Read on</p>{spam}{links}<p>{PROSE}</p><p>End</p></article>{spam}<p>x</p>"
    assert main_text(html).split("\n\n") == ["Title", PROSE.strip(), PROSE.strip(), "End"]


RUSSIAN = "утром над рекой поднялся густой туман а старый паромщик молча смотрел как вода уносит последние жёлтые листья "
CHINESE = "清晨河面上升起浓雾老船夫默默看着流水带走最后几片黄叶他想起很多年前离开家乡的那个早晨母亲站在门口没有说话"


@pytest.mark.parametrize("text", [RUSSIAN * 3, RUSSIAN, CHINESE])
def test_pages_in_other_languages(text):
    notice = f"<p>{PROSE[:70]}</p>" if text == RUSSIAN * 3 else ""
    paragraphs = f"<p>{text}</p>" * 3 + "<p>Да</p>"
    html = f"<nav><a href=x>Home</a></nav>{paragraphs}{notice}<footer>x</footer>"
    assert main_text(html).split("\n\n")[:4] == [*[text.strip()] * 3, "Да"]


def test_keywords_on_a_page_in_a_listed_language():
    spam = "<p>" + "buy cheap shoes " * 12 + "</p>"
    assert main_text(f"<p>{PROSE}</p><p>{PROSE}</p>{spam}") == f"{PROSE.strip()}\n\n{PROSE.strip()}"


def test_article_text_of_all_pages(spark):
    """The given pages have their text in one article element, none of it in menus, and nothing else outside."""
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").toLocalIterator():
        start = row["html"].index("<article>")
        inside = blocks(row["html"][start : row["html"].index("</article>", start)])
        assert main_text(row["html"]) == "\n\n".join(b.text for b in inside)


class _Reader(HTMLParser):
    """The block texts of an article by the standard library's parser, which shares nothing with the operator."""

    BLOCKS = {"article", "p", "div", "h1", "h2", "h3", "h4", "ul", "ol", "li", "table", "tr", "td", "th", "blockquote", "pre", "section", "figure", "hr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.hidden, self.parts, self.texts = False, 0, [], []

    def cut(self):
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text and self.inside:
            self.texts.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.cut()
        if tag == "br":
            self.parts.append(" ")
        self.inside = self.inside or tag == "article"
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.cut()
        self.inside = self.inside and tag != "article"
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.parts.append(data)


def _read(html):
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return "\n\n".join(reader.texts)


def _unmarked(html):
    """The page with its article elements as plain ones."""
    return re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", html)


def test_text_of_all_pages_by_another_parser(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    expected = [_read(html) for html in pages]
    assert all(expected) and [main_text(html) for html in pages] == expected
    plain = [main_text(_unmarked(html)) == text for html, text in zip(pages, expected, strict=True)]
    assert sum(plain) >= 0.98 * len(pages)  # without the mark the signs of the blocks alone find the text


def test_an_undecided_block_takes_the_label_of_its_nearest_neighbour():
    good, bad, open_ = f"<p>{PROSE}</p>", "<p><a href=x>one</a> <a href=y>two</a></p>", "<p>Two words</p>"
    for start, end in (("", ""), ("<article>", "</article>")):
        page = f"{start}{good}{open_}{bad}{open_}{open_}{bad}{good}{end}"
        assert main_text(page).split("\n\n") == [PROSE.strip(), "Two words", PROSE.strip()]
    assert main_text(f"<article>{open_}</article>{open_}") == "Two words"  # the mark, where nothing is decided


@pytest.mark.parametrize("part", ["<a '> '", "<div>|</p>", "<a \"' >", "<script ", "<p class=x'>", "<a href='|\"", "<", "<a b='>' ", "<i"])
def test_malformed_pages_take_time_in_proportion(part):
    def seconds(n):
        first, _, second = part.partition("|")
        page, least = first * n + second * n, 9.0
        for _ in range(3):
            begun = time.perf_counter()
            main_text(page)
            least = min(least, time.perf_counter() - begun)
        return least

    assert seconds(20_000) < 25 * max(seconds(2_000), 0.004)


def test_quotes_in_tags():
    assert main_text(f"<p title='a > b'>{PROSE}</p>") == PROSE.strip()
    assert main_text(f"<p title=\"it's > b\">{PROSE}</p>") == PROSE.strip()
    assert main_text(f"<p title='a>{PROSE}</p>") == PROSE.strip()  # never closed: the tag ends at its first >
    assert main_text(f"<p a='1' b=\"2\" c='>'>{PROSE}</p><p d='x>{PROSE}</p>").split("\n\n") == [PROSE.strip()] * 2


def test_extraction_over_pages(spark, pages):
    rows = extract_text(pages.withColumn("text", F.lit("clash"))).collect()
    assert len(rows) == pages.count() and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert extract_text(pages.limit(0)).count() == 0


def test_transfers_move_the_fewest_bytes():
    moves = reshard.transfers({0: 100, 1: 10, 2: 10}, [40, 40, 40])
    assert moves == {(0, 0): 40, (0, 1): 30, (0, 2): 30, (1, 1): 10, (2, 2): 10}
    random.seed(8)
    for _ in range(50):
        old = {i: random.randint(0, 50) for i in range(random.randint(1, 6))}
        capacities = reshard.even_capacities(sum(old.values()), random.randint(1, 6))
        moves = reshard.transfers(old, capacities)
        assert all(sum(n for (a, _), n in moves.items() if a == i) == size for i, size in old.items())
        assert all(sum(n for (_, b), n in moves.items() if b == j) <= c for j, c in enumerate(capacities))
        stay = sum(n for (a, b), n in moves.items() if a == b)
        assert stay == sum(min(old.get(j, 0), c) for j, c in enumerate(capacities))
    with pytest.raises(ValueError):
        reshard.transfers({0: 5}, [4])


def _by_source():
    return F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(3))


def _resharded(docs, shard, shards, folder, file_rows=4):
    old = reshard.write_shards(docs, shard, f"{folder}/old", file_rows)
    new = reshard.reshard(old, docs.schema, shards, path=f"{folder}/new")
    return old, new, reshard.sharded_rows(new.layout, docs.schema)


@pytest.mark.parametrize("frame", ["odd_docs", "clashing", "no_docs"])
def test_resharding(frame, request, tmp_path):
    docs = request.getfixturevalue(frame)
    _, new, placed = _resharded(docs, _by_source(), 4, tmp_path)
    assert placed.select("row.*").dtypes == docs.dtypes
    rows = placed.collect()
    assert sorted(str(r["row"]) for r in rows) == sorted(str(r) for r in docs.collect())
    assert all(r["size"] == len((r["row"]["text"] or "").encode()) + 1 for r in rows)
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    before = {str(r["row"]): r["old"] for r in docs.select(F.struct("*").alias("row"), _by_source().alias("old")).collect()}
    assert all(r["old_shard"] == before[str(r["row"])] for r in rows)


def test_a_hot_shard_is_evened_out(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', 50 + int(id % 100)) as text")
    _, new, placed = _resharded(docs, F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0), 5, tmp_path, 50)
    sizes = [r["n"] for r in placed.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 800
    moved = placed.where("shard <> old_shard").agg(F.sum("size")).first()[0]
    assert abs(moved - new.moved_bytes) < 1000


def test_files_without_a_cut_are_not_written(spark, tmp_path):
    """Four old shards to five: at most one file a cut is read and written, far less than what moves."""
    docs = spark.range(8000).selectExpr("id as doc_id", "repeat('x', 50 + int(id % 100)) as text")
    old, new, placed = _resharded(docs, (F.col("doc_id") % 4).cast("int"), 5, tmp_path, 20)
    stored = {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in tmp_path.glob("old/*/*/*.parquet")}
    assert placed.count() == 8000
    assert {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in stored} == stored
    total = old.agg(F.sum("bytes")).first()[0]
    assert abs(new.moved_bytes - total / 5) < 2000  # a fifth of each old shard goes to the new one
    assert 0 < new.written_bytes <= 4 * 20 * 150 < new.moved_bytes / 10
    kept = new.layout.join(old, "file", "left_semi").count()
    assert kept >= old.count() - 4 and len(list(tmp_path.glob("new/*/*/*.parquet"))) <= 8


def test_shards_that_fit_stay(spark, tmp_path):
    docs = spark.range(100).selectExpr("id as doc_id", "'abc' as text")
    old, new, placed = _resharded(docs, (F.col("doc_id") % 2).cast("int"), 2, tmp_path)
    assert (new.moved_bytes, new.written_bytes) == (0, 0) and placed.where("shard <> old_shard").count() == 0
    assert placed.count() == 100 and sorted(map(str, new.layout.collect())) == sorted(map(str, old.collect()))


def test_a_text_larger_than_a_shard_goes_whole(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (100_000 if i == 3 else 10)) for i in range(40)], "doc_id long, text string")
    _, _, placed = _resharded(docs, F.lit(0), 4, tmp_path)
    assert sorted(r["row"]["doc_id"] for r in placed.collect()) == list(range(40))

import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import *  # noqa: F403
from tallyloom.llm import decontaminate, line_crf, line_dedup, ngram_join, quality_rules
from tallyloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def kept_lines(rows, least=20, docs=3):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    held = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            held[key(line)].add(r["doc_id"])
    for r in rows:
        lines = (r["text"] or "").split("\n")
        keeper = {k: max((i for i in v if i is not None), default=None) for k, v in held.items()}
        kept = [x for x in lines if len(key(x)) < least or len(held[key(x)]) < docs or keeper[key(x)] == r["doc_id"]]
        yield r["doc_id"], len(lines), len(lines) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("frame", ["odd_docs", "clashing", "no_docs"])
def test_line_dedup(frame, request):
    docs = request.getfixturevalue(frame)
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(kept_lines(docs.collect()), key=str)


def test_other_columns_are_kept(clashing, kept_columns, spark):
    kept_columns(line_dedup.dedup_lines(clashing), ["n_lines", "n_dropped", "kept_text"])
    kept_columns(quality_rules.measure(clashing), quality_rules.MEASURES)
    kept_columns(quality_rules.ledger(clashing), [*quality_rules.MEASURES, "failed"])
    kept_columns(ngram_join.one_of_each(clashing))
    bench = spark.createDataFrame([(1, "nothing of the kind occurs in here")], "item_id long, text string")
    kept_columns(decontaminate.without_hits(clashing, bench))
    kept_columns(line_crf.score_documents(clashing, line_crf.train(clashing, spark.createDataFrame([], "doc_id long, quality int"))), ["score"])


def test_a_line_of_two_documents_and_one_without_an_id(spark):
    import duckdb

    from tallyloom.llm import sql

    line = "a line that is long enough to count"
    rows = [(1, line), (2, f"{line}\nown"), (None, line), (None, f"x\n{line}"), (3, "a line of two documents only"), (None, "a line of two documents only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(docs).selectExpr("doc_id", "n_lines", "n_dropped", "sha2(kept_text, 256)").collect()
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.sql(sql.OP8).fetchall()))
    assert sum(r["n_dropped"] for r in got) == 3


def test_line_dedup_many_lines(make_docs):
    shared, spread = "A line that many documents share", "  a LINE that many documents share\t"
    texts = ["\n".join([f"own line number {i} of the text {j}" for j in range(70)] + [shared if i % 2 else spread] * 2) for i in range(9)]
    docs = make_docs(texts)
    got = sorted(map(tuple, line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()))
    assert got == sorted(kept_lines(docs.collect())) and [x[2] for x in got] == [2] * 8 + [0]
    bitmaps = line_dedup.keep_bitmaps(docs).collect()
    assert len(bitmaps) == 8 and all(r["dropped"] == {1: 0b11000000} for r in bitmaps)


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(BLANKS)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), len(lines)


@pytest.mark.parametrize("frame", ["odd_docs", "clashing", "no_docs"])
def test_measures(frame, request):
    docs = request.getfixturevalue(frame)
    rows = quality_rules.measure(docs).collect()
    for r in rows:
        assert tuple(r[c] for c in quality_rules.MEASURES[:6]) == measures(r["text"])
    assert len(rows) == docs.count()


def test_policies_read_the_ledger(spark, make_docs):
    texts = ["w" + " w".join(map(str, range(40))), "few words", "#$ x " * 30, "same again and again " * 30, None, "LOUD WORDS EVERYWHERE " + " ".join(f"W{i}X" for i in range(30))]
    rows = quality_rules.ledger(make_docs(texts)).cache()
    failed = {r["doc_id"]: r["failed"] for r in rows.collect()}
    bit = quality_rules.rule_bit
    assert failed[0] == 0 and failed[1] == failed[4] == bit("few_words")
    assert failed[2] == bit("repeated_windows") | bit("many_symbols") | bit("odd_word_length") or failed[2] & bit("many_symbols")
    assert failed[3] == bit("repeated_windows") and failed[5] & bit("shouting")
    for version, rules in quality_rules.POLICIES.items():
        kept = rows.where(quality_rules.passes(version)).count()
        assert kept == sum(not f & quality_rules.policy_mask(version) for f in failed.values())
        for r in quality_rules.ablations(rows, version).collect():
            others = quality_rules.policy_mask(version) & ~bit(r["rule"])
            assert r["n_kept"] == kept and r["n_kept_without"] == sum(not f & others for f in failed.values())
            assert r["n_failed"] == sum(bool(f & bit(r["rule"])) for f in failed.values())
        assert {r["rule"] for r in quality_rules.ablations(rows, version).collect()} == set(rules)


def test_a_notice_at_both_ends_is_no_repetition(make_docs):
    body = " ".join(f"word{i}" for i in range(30))
    texts = [f"the notice\n{body}\nthe notice", "\n".join(f"{body}{i}" if i % 2 else "again" for i in range(10))]
    rows = quality_rules.ledger(make_docs(texts))
    assert [r["doc_id"] for r in rows.where(quality_rules.passes("v2")).collect()] == []
    bit = quality_rules.rule_bit("several_repeated_lines")
    assert {r["doc_id"]: r["failed"] & bit for r in rows.collect()} == {0: 0, 1: bit}


def brute_components(rows, size=5):
    sets = defaultdict(set)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER))
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
        sets[r["doc_id"]] = grams
    root = {k: k for k in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.fixture(scope="module")
def copies(make_docs):
    """Exact and near copies, chains of them, texts that share one passage, and short texts."""
    random.seed(6)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    passage, texts = [word() for _ in range(40)], []
    for n in (6, 12, 30, 80, 200):
        base = [word() for _ in range(n)]
        for _ in range(14):
            copy = list(base)
            for _ in range(random.randint(0, max(1, n // 30))):
                copy[random.randrange(n)] = word()
            texts.append(" ".join(copy))
            base = copy if random.random() < 0.3 else base
    texts += [" ".join([word() for _ in range(60)] + passage) for _ in range(25)]
    texts += ["one two", "One  TWO", "one", "", None, "one two three four five", texts[3].upper()]
    return make_docs(texts)


@pytest.mark.parametrize("limit", [50, 4, 1])
def test_similar_documents(copies, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "FREQUENT", limit)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(copies).collect()}
    assert got == brute_components(copies.collect())


def brute_pairs(rows, size=5):
    first, sets = {}, {}
    for r in sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        words = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER))
        grams = frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)) if words else frozenset()
        if grams and first.setdefault(grams, r["doc_id"]) == r["doc_id"]:
            sets[r["doc_id"]] = grams
    return sorted((a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))


@pytest.mark.parametrize("limit", [50, 4, 1])
def test_similar_pairs_are_all_links(copies, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "FREQUENT", limit)
    expected = brute_pairs(copies.collect())
    assert sorted(map(tuple, ngram_join.similar_pairs(copies).collect())) == expected
    linked = {x for pair in expected for x in pair}
    assert len(expected) > len(linked)  # far more links than a component needs


def _family(template, own, count, first, seed):
    """Texts of a common passage and words of their own."""
    chosen = random.Random(seed)
    return [
        (first + i, " ".join(template + [f"w{chosen.randrange(10**9)}" for _ in range(own)]), None, None, None) for i in range(count)
    ]


@pytest.mark.parametrize("mixed", [False, True])
def test_a_template_family_grows_in_proportion(spark, monkeypatch, mixed):
    """Pages of one template, too different to be similar: what meets grows as the family does, not as its square. With
    ``mixed``, pages with less text of their own, which are similar to each other, lie between them."""
    template = [f"t{i}" for i in range(104)]
    counted = []
    meeting = ngram_join._meeting

    def watched(rest, settled):
        often, rare = rest.where("kind = 2"), rest.where("kind < 2")
        others, sized, on = often.where("other"), ngram_join._sized(often), ["signature", "step"]
        sides = [(ngram_join._reaching(others, True), sized, on), (ngram_join._reaching(others, False), sized.where("not other"), on)]
        sides.append((rare, rare, ["signature"]))
        sums = []
        for a, b, keys in sides:
            held = [x.groupBy(keys).agg(F.count(F.lit(1)).alias(n)) for x, n in ((a, "m"), (b, "n"))]
            sums.append(held[0].join(held[1], keys).agg(F.sum(F.col("m") * F.col("n"))).first()[0] or 0)
        counted[-1] += sum(sums)
        return meeting(rest, settled)

    monkeypatch.setattr(ngram_join, "_meeting", watched)
    for count in (300, 600):
        counted.append(0)
        rows = _family(template, 16, count, 0, 1)
        rows += _family(template, 12, count // 3, 10_000, 2) if mixed else []
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(docs).collect()}
        assert all(found[i] == (116, i) for i in range(count))
        assert all(v[1] == 10_000 for i, v in found.items() if i >= 10_000) and len(found) == len(rows)
    assert counted[1] <= 2.2 * counted[0] + 1_000, counted


def _posting(signature, node, n, common, component):
    return signature, node, n, 2, common, component


def test_postings_reach_only_sizes_that_their_signature_has(spark):
    """Sets that are far from all of a group's sizes, or share too little, take no step of sizes at all."""
    family = [_posting(1, i, 100, 100, 0) for i in range(50)]
    far = [_posting(1, 100 + i, 1000, 900, 100 + i) for i in range(20)]
    near = [_posting(1, 200, 110, 110, 200), _posting(1, 201, 110, 60, 201)]
    schema = "signature long, node long, n int, kind int, common int, component long"
    rest = ngram_join._with_others(spark.createDataFrame(family + far + near, schema))
    others, main = rest.where("other"), rest.where("not other")
    assert ngram_join._reaching(others, False).count() > 100
    reached = ngram_join._reaching(others, False, main)
    assert [r["node"] for r in reached.collect()] == [200] and reached.columns == [*rest.columns, "step"]
    assert reached.join(ngram_join._sized(main).select("signature", "step").distinct(), ["signature", "step"]).count() == 1


def test_the_main_component_of_a_signature_is_the_largest(spark):
    """The one set with the fewest rare tokens does not make a large group look for it."""
    rows = [_posting(1, i, 100, 90, 5) for i in range(5, 45)] + [_posting(1, 1, 100, 100, 1), _posting(2, 1, 9, 9, 1), _posting(2, 5, 9, 9, 5)]
    schema = "signature long, node long, n int, kind int, common int, component long"
    rest = ngram_join._with_others(spark.createDataFrame(rows, schema))
    assert sorted((r["signature"], r["node"]) for r in rest.where("other").collect()) == [(1, 1), (2, 5)]
    assert rest.count() == len(rows) and "main" not in rest.columns


def test_a_worker_returns_freed_memory_after_its_batches():
    import pyarrow as pa

    held = pa.default_memory_pool().bytes_allocated()
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    assert [b.to_pydict() for b in ngram_join._released(iter(batches))] == [{"x": [i]} for i in range(3)]
    del batches
    assert pa.default_memory_pool().bytes_allocated() <= held


FREED = """
import re
import numpy as np
from tallyloom.llm.tables import released

def anonymous():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"Anonymous:\\s+(\\d+)", file.read()).group(1)) // 1024

def run():
    global last
    arrays = [np.ones(8_000) for _ in range(3_000)]
    last = arrays[-1]
    yield len(arrays)

before = anonymous()
list(released(run()))
print(anonymous() - before)
"""


def test_a_worker_returns_the_memory_of_its_arrays():
    """192 MB of arrays below the C library's threshold, of which the one that lies last is still held."""
    out = subprocess.run([sys.executable, "-c", FREED], capture_output=True, text=True, check=True, timeout=60).stdout
    assert int(out) < 60, out


def test_no_group_holds_every_occurrence_of_a_token(spark, monkeypatch):
    """A passage in all documents is sent once for each run of tokens that a task sorts."""
    DataFrame = type(spark.range(0))  # the class whose methods the session's tables have
    sent = []
    group_by = DataFrame.groupBy

    def watched(self, *keys):
        if isinstance(keys[0], str) and keys == ("part",):
            rows = self.collect()
            sent.append(sum(len(ngram_join._unpack(bytes(r["data"]))) for r in rows))
        return group_by(self, *keys)

    monkeypatch.setattr(DataFrame, "groupBy", watched)
    docs = spark.createDataFrame([(i, " ".join(f"t{j}" for j in range(54))) for i in range(400)], "doc_id long, text string").coalesce(1)
    found, bits = ngram_join.frequent_tokens(docs, 20_000, 5)
    assert len(found) == 50 and sent == [50]
    two = docs.unionByName(spark.createDataFrame([(1000 + i, "some other words of a text") for i in range(50)], "doc_id long, text string"))
    assert (ngram_join.frequent_tokens(two, 20_000, 5)[0] == found).all()  # a token in 50 documents is not frequent


def test_similar_pairs_of_odd_rows(odd_docs, no_docs):
    assert sorted(map(tuple, ngram_join.similar_pairs(odd_docs).collect())) == brute_pairs(odd_docs.collect())
    assert ngram_join.similar_pairs(no_docs).count() == 0


@pytest.mark.parametrize("frame", ["odd_docs", "clashing"])
def test_similar_documents_odd_rows(frame, request):
    docs = request.getfixturevalue(frame)
    rows = ngram_join.similar_documents(docs).collect()
    expected = brute_components([r for r in docs.collect() if r["doc_id"] is not None])
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


def test_rows_that_share_an_id_but_not_the_text(make_docs):
    random.seed(12)
    a, b, c = (" ".join(random.choices("abcdefghijklmnop", k=120)) for _ in range(3))
    near = lambda text: text + " x"
    rows = [(5, a), (5, b), (5, b), (5, ""), (3, near(a)), (7, near(b)), (3, c), (9, near(c)), (None, a), (1, "alone")]
    docs = make_docs([], [(i, t, "en", "s", len(t)) for i, t in rows])
    got = ngram_join.similar_documents(docs).collect()
    place = {(5, a): 3, (5, b): 5, (5, ""): 5, (3, near(a)): 3, (7, near(b)): 5, (3, c): 3, (9, near(c)): 3, (1, "alone"): 1}
    size = lambda text: min(len(text), max(1, len({tuple(text.split()[k : k + 5]) for k in range(len(text.split()) - 4)})))
    expected = [(i, size(t), place.get((i, t))) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert sorted(map(tuple, ngram_join.similar_pairs(docs).collect())) == [(3, 5), (3, 9), (5, 7)]
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = [(3, near(a)), (5, b), (5, ""), (3, c), (None, a), (1, "alone")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_similar_documents_of_none(no_docs):
    assert ngram_join.similar_documents(no_docs).count() == 0


def test_components(spark):
    random.seed(1)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    pairs += [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {k: v for k, v in root.items() if k != 200}


def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_benchmark_hits_equal_full_alignment(spark, make_docs):
    random.seed(9)
    word = lambda: "".join(random.choices("abcde", k=random.randint(2, 6)))
    items = [" ".join(word() for _ in range(n)) for n in (3, 8, 20, 30)]
    texts = [None, "", "short"]
    for n in range(40):
        item = list(random.choice(items))
        for _ in range(random.randint(0, len(item) // 8)):
            at = random.randrange(len(item))
            item[at : at + random.randint(0, 1)] = random.choice(["", "z", "q"])
        around = " ".join(word() for _ in range(random.randint(0, 20)))
        texts.append((around + " " + "".join(item) + " " + around).upper().replace(" ", "\n "))
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "tiny")], "item_id long, text string")
    hits = decontaminate.benchmark_hits(make_docs(texts), bench).collect()
    best = {}
    for h in hits:
        best[h["doc_id"], h["item_id"]] = min(h["edits"], best.get((h["doc_id"], h["item_id"]), 99))
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            item, plain = decontaminate.normalized(item), decontaminate.normalized(text)
            n = edits(item, plain)
            if len(item) >= decontaminate.Q and n <= decontaminate.edit_budget(len(item)):
                expected[d, i] = n
    assert best == expected and len(expected) > 20


def _found(items, texts):
    block = decontaminate.Block.of(list(range(len(items))), items)
    return sorted(decontaminate._matches(block, texts))


def test_repeating_texts_equal_full_alignment(monkeypatch):
    """Runs, periods and noise, with every pair taken for a repeating one and with none."""
    random.seed(12)
    items = ["-" * 60, "ab" * 40, "-" * 30 + "the end" + "-" * 30, "x" * 9]
    texts = ["", "-" * 7, "-" * 55, "-" * 400, "ab" * 33 + "ba" * 60, "y" * 50 + "-" * 58 + "y" * 50, "x" * 30]
    for _ in range(25):
        text = list(random.choice(["-" * 90, "ab" * 55, items[2] * 2, "zx" * 20 + "x" * 9]))
        for _ in range(random.randint(0, 12)):
            text[random.randrange(len(text))] = random.choice(["", "q", "-", "ab"])
        texts.append("".join(text))
    plain = _found(items, texts)
    monkeypatch.setattr(decontaminate, "PIECE", 500)
    assert _found(items, texts) == plain
    monkeypatch.setattr(decontaminate, "DENSE", 0)
    monkeypatch.setattr(decontaminate, "MERGED", 20)
    dense = _found(items, texts)
    for hits in (plain, dense):
        best = {}
        for t, i, start, end, n in hits:
            best[t, i] = min(n, best.get((t, i), 99))
            assert edits(items[i], texts[t][start:end]) <= n <= decontaminate.edit_budget(len(items[i]))
        expected = {}
        for t, text in enumerate(texts):
            for i, item in enumerate(items):
                n = edits(item, text)
                if n <= decontaminate.edit_budget(len(item)):
                    expected[t, i] = n
        assert best == expected and len(expected) > 20
        spans = sorted((t, i, start, end) for t, i, start, end, _ in hits)
        assert all(a[:2] != b[:2] or a[3] <= b[2] for a, b in zip(spans, spans[1:], strict=False))
    assert [h[2:4] for h in dense if h[:2] == (3, 0)] == [(60 * k, 60 * k + 60) for k in range(6)]


def test_a_long_run_keeps_its_memory_bound():
    """A run of 1,000,000 equal characters against items with runs of 600: less than 400 MB beside the interpreter."""
    code = """
import resource
from tallyloom.llm import decontaminate as d
block = d.Block.of([0, 1, 2], ["-" * 600, "=" * 200 + "-" * 400, "a short text with -------- in it"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
hits = list(d._matches(block, ["-" * 1_000_000]))
print(len(hits), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    count, megabytes = map(int, done.stdout.split())
    assert count == 1_000_000 // 600 and megabytes < 400


def test_short_benchmark_items_are_found(spark, make_docs):
    items = [(0, "Aa"), (1, "b"), (2, "seven c"), (3, " "), (4, "aa"), (5, "é😀")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.benchmark_hits(make_docs(["aaaaa b", "x  Seven\nC", "b", "", None, "qé😀q"]), bench).collect()
    expected = [(0, i, s, s + 2, 0) for i in (0, 4) for s in (0, 2)] + [(0, 1, 6, 7, 0), (1, 2, 2, 9, 0), (2, 1, 0, 1, 0), (5, 5, 1, 3, 0)]
    assert sorted(map(tuple, hits)) == sorted(expected)


def test_benchmark_blocks_and_empty_tables(spark, odd_docs, no_docs, monkeypatch):
    bench = spark.createDataFrame([(i, f"{r}") for i, r in enumerate(["aer3 completely other words", "one two three four"])], "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.benchmark_hits(odd_docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1)
    assert sorted(map(tuple, decontaminate.benchmark_hits(odd_docs, bench).collect())) == whole == [(4, 1, 0, 18, 0)]
    assert decontaminate.benchmark_hits(no_docs, bench).count() == 0
    assert decontaminate.benchmark_hits(odd_docs, bench.limit(0)).count() == 0


def test_forward_backward_equals_enumeration():
    from itertools import product

    random.seed(0)
    good, moves = np.array([0.3, -1.2, 0.7, 2.0, -0.4]), np.array([[0.5, -0.3], [-0.8, 0.9]])
    alpha, beta = line_crf.forward_backward(good, moves, np.array([0, 4, 5]))
    weight = Counter()
    for states in product((0, 1), repeat=4):
        score = sum(good[i] for i in range(4) if states[i]) + sum(moves[a, b] for a, b in zip(states, states[1:]))
        for i, s in enumerate(states):
            weight[i, s] += np.exp(score)
    model = line_crf.LineCrf(np.array([1.0]), moves)
    p = model.marginals(good[:, None], np.array([0, 4, 5]))
    assert p[:4] == pytest.approx([weight[i, 1] / (weight[i, 0] + weight[i, 1]) for i in range(4)])
    assert p[4] == pytest.approx(1 / (1 + np.exp(0.4)))


def test_quality_scores(spark, odd_docs, clashing, no_docs):
    sf = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = line_crf.train(docs, marks)
    rows = line_crf.score_documents(docs, model).join(marks, "doc_id").where(line_crf.held_out(F.col("doc_id"))).collect()
    right = sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)
    for frame in (odd_docs, clashing):
        scored = line_crf.score_documents(frame, model).collect()
        assert len(scored) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert line_crf.score_documents(no_docs, model).count() == 0
    nothing = line_crf.train(docs, marks.limit(0))
    assert {r["score"] for r in line_crf.score_documents(odd_docs, nothing).collect()} == {0.5}

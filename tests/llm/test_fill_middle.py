import hashlib
import random
import re

from frames import *  # noqa: F403
from tallyloom.llm import fill_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    """The contract worked out on a list of units."""
    units = UNIT.findall(text)
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < 20
    return len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_every_cut_of_every_block_size():
    random.seed(1)
    texts = ["", "a", "é", "ab", "1", "a1", "😀b漢", "aaaa" * 9, "\n\0x<P", "Zz`{@[" * 3]
    texts += ["".join(random.choices("aZé 漢😀1<\n", k=random.randint(1, 60))) for _ in range(60)]
    for text in texts:
        units, data = UNIT.findall(text), text.encode()
        for block in (1, 2, 3, 7, 64):
            index = fim.BlockIndex(data, block)
            assert (index.units, index.points) == (len(units), len(text))
            for k in range(len(units) + 1):
                head = "".join(units[:k])
                assert index.cut(k) == (len(head.encode()), len(head))


def test_forms_and_restoring():
    random.seed(2)
    forms = set()
    for doc in range(400):
        text = "".join(random.choices(["ab", "<", "P>", "S", ">", "<S", "é", " ", "M>"], k=random.randint(0, 12)))
        done = fim.rewrite(doc, text.encode(), 4)
        assert (done.units, done.form, done.prefix_chars, done.middle_chars, done.output.decode()) == brute(doc, text)
        assert fim.restore(done.output, done.form) == text.encode()
        forms.add(done.form)
    assert forms == {"plain", "psm", "spm"}


def test_documents(odd_docs, no_docs, clashing, make_docs):
    def check(docs):
        rows = fim.fill_middle(docs).collect()
        texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        found = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in rows]
        assert sorted(found, key=str) == sorted(((i, *brute(i, t), t) for i, t in texts), key=str)
        for r in rows:
            assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
            assert r["restored_sha256"] == hashlib.sha256(r["restored"].encode()).hexdigest()

    check(odd_docs)
    check(make_docs(["y" * 3_000_000, "漢 " * 400_000, "é1" * 10, "<P>", "x<M>y"], [(-7, "negative id", None, None, None)]))
    assert fim.fill_middle(no_docs).count() == 0
    assert fim.fill_middle(clashing).count() == odd_docs.count()
    assert "output" not in fim.fill_middle(odd_docs, with_texts=False).columns

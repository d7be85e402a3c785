import random

from pyspark.sql import functions as F

from tests.conftest import SF
from weftline.llm import leakage as L
from weftline.session import table


def contains(item, doc):
    """Brute force: some window of 20 item words within edit distance 2 of a stretch of the document."""
    n = L.WINDOW
    for a in range(len(item) - n + 1):
        win = item[a : a + n]
        row = [0] * (len(doc) + 1)
        for i, x in enumerate(win, 1):
            new = [i]
            for j, y in enumerate(doc, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        if min(row) <= L.EDITS:
            return True
    return False


def test_matches_brute_force():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(40)]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(15, 40)))) for k in range(8)]
    pats = L.Patterns(items)
    seen = set()
    for _ in range(60):
        k, t = rnd.choice(items)
        w = t.split()
        a = rnd.randrange(0, max(1, len(w) - 18))
        part = w[a : a + rnd.randrange(16, 26)]
        for _ in range(rnd.randrange(0, 4)):
            i = rnd.randrange(len(part))
            rnd.choice([lambda: part.__setitem__(i, "zz"), lambda: part.pop(i), lambda: part.insert(i, "yy")])()
        doc = [rnd.choice(vocab) for _ in range(6)] + part + [rnd.choice(vocab) for _ in range(6)]
        got = {i for i, _ in pats.contained(" ".join(doc))}
        want = {i for i, x in items if contains(x.split(), doc)}
        assert got == want
        seen |= {bool(want)}
    assert seen == {True, False}


def test_words_ignore_layout():
    a = "The Ekkdor ledger lists 882,862 fishers, 21.98 percent of l'aide Nixjas-Hilfe — crédits each."
    b = "<p>THE **Ekk​dor** <b>ledger</b> lists<br/>\n> 882862 fishers 2198 percent of l’aide\tNixjas-hilfe; crédits   each</p>"
    assert L.words(a) == L.words(b) and len(L.words(a)) == 13
    for long in ("\n" * 300_000 + ")", "<p" * 100_000, "1," * 200_000, "'" * 300_000, ") " * 200_000):
        L.words(long)
    assert L.words(None) == L.words("") == []
    assert L.words("1) 校准 x") == ["校", "准", "x"]


def test_spark_edge_cases(spark):
    item = " ".join(f"word{i}" for i in range(30))
    docs = [(1, "intro " + item.upper() + " end"), (1, item), (2, None), (3, ""), (None, item), (4, " ".join(item.split()[:17])), (5, ("filler " * 200_000) + item)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(9), "n": F.lit(1)})
    items = spark.createDataFrame([(10, item), (10, item), (11, "too short"), (12, None), (None, item + " more")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked(d, items).collect()}
    assert got == {(x, y) for x in (1, None, 5) for y in (10, None)}
    old, L.ITEM_BLOCK = L.ITEM_BLOCK, 1
    assert {(r["doc_id"], r["item_id"]) for r in L.leaked(d, items).collect()} == got
    L.ITEM_BLOCK = old
    assert L.leaked(d.where("false"), items).count() == L.leaked(d, items.where("false")).count() == 0


def test_long_tags_do_not_hide_an_item(spark):
    w = [f"word{i}" for i in range(24)]
    tag = '<a href="https://example.org/' + "x" * 20_000 + '">'
    p = L.Patterns([(1, " ".join(w))])
    for t in (tag, tag.replace("<a", "<p"), "<b>"):
        assert p.contained(" ".join(w[:12]) + " " + t + " ".join(w[12:])) == [(1, 24)]


def test_blocks_are_bounded_by_characters(spark):
    items = [(k, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(5)]
    docs = spark.createDataFrame([(k, t) for k, t in items], "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    old, L.ITEM_CHARS = L.ITEM_CHARS, 250
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked(docs, it).collect()}
    L.ITEM_CHARS = old
    assert got == {(k, k) for k in range(5)}


def test_exact_windows_are_all_found(spark):
    """A lower bound by other means: every document that shares 20 words in a row with an item, from hashes of windows."""
    docs, items = table(spark, SF, "documents").select("doc_id", "text").collect(), table(spark, SF, "eval_items").select("item_id", "text").collect()
    window = lambda t: (lambda w: {tuple(w[i : i + L.WINDOW]) for i in range(len(w) - L.WINDOW + 1)})(L.words(t))
    by = {}
    for r in items:
        for x in window(r["text"]):
            by.setdefault(x, set()).add(r["item_id"])
    least = {(d["doc_id"], i) for d in docs for x in window(d["text"]) for i in by.get(x, ())}
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked(table(spark, SF, "documents"), table(spark, SF, "eval_items")).collect()}
    assert least and least <= got

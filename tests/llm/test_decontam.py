import random
import re

from gleanrow.llm import decontam

from .helpers import ODD, documents


def plain_words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(texts, items):
    out = []
    for t in texts:
        w, hit, found = plain_words(t), set(), set()
        for item, text in items:
            v = plain_words(text)
            k = min(13, len(v))
            wins = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
            for i in range(len(w) - k + 1) if k else ():
                if tuple(w[i : i + k]) in wins:
                    hit |= set(range(i, i + k))
                    found.add(str(item))
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def corpus():
    rng = random.Random(4)
    words = [f"v{i}" for i in range(50)] + ["É", "naïve"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.randrange(14, 40))) for i in range(8)] + [(10, "three Short words"), (2, "one"), (3, None), (4, "..."),
        (5, "the same item " * 6), (6, "the same item " * 6)]
    texts = [*ODD, items[0][1].upper(), "x, " + items[1][1].replace(" ", "-") + " y", say(300) + " " + items[2][1] + " " + say(400),
        say(2000) + " " + items[3][1], "Three short WORDS!", "the same item " * 40, say(50)]
    return texts, items


def test_against_plain_both_ways(spark):
    texts, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontam.BROADCAST_ROWS, 3):
        rows = decontam.report(documents(spark, texts), bench, broadcast_rows=most).orderBy("doc_id").collect()
        assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows] == plain(texts, items)


def test_removal(spark):
    texts, items = corpus()
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = plain(texts, items)
    for most in (decontam.BROADCAST_ROWS, 3):
        left = decontam.decontaminate(docs, bench, broadcast_rows=most)
        assert left.columns == docs.columns
        assert sorted(r["doc_id"] for r in left.collect()) == [i for i, x in enumerate(want) if not x[3]]
    spans = {r["doc_id"]: r["clean_words"] for r in decontam.remove_spans(docs, bench).collect()}
    assert [len(spans[i]) for i in range(len(texts))] == [x[0] - x[1] for x in want]


def test_empty_tables(spark):
    texts, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.report(documents(spark, []), bench).count() == 0
    assert decontam.report(documents(spark, texts), bench.limit(0)).where("contaminated or n_hit > 0").count() == 0
    assert decontam.decontaminate(documents(spark, texts), bench.limit(0)).count() == len(texts)


def test_repeated_rows_and_letters_that_lower_changes(spark):
    """Only A-Z are lower-cased: other letters that lower() would join are told apart by the digest."""
    item = "Σας ΣΑΣ É naïve İx one two three four five six seven eight nine ten"
    texts = [item, item, item.replace("É", "é"), item.replace("one", "ONE").replace(" ", "."), "ς" + item[1:], None, None]
    bench = spark.createDataFrame([(1, item), (None, "eight nine ten")], "item_id long, text string")
    ids = [3, 3, 4, 5, 6, 7, 7]
    rows = sorted(decontam.report(documents(spark, texts, ids), bench).collect(), key=lambda r: r["doc_id"])
    want = plain(texts, [(1, item), (None, "eight nine ten")])
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in rows] == [(x[0], x[1], x[3]) for x in want]
    assert [r["items"] for r in rows] == [[i for i in x[2] if i != "None"] for x in want]


def test_more_windows_than_are_broadcast(spark):
    """Over 50,000 windows, whose digests are shuffled."""
    rng = random.Random(14)
    items = [(i, " ".join(f"v{rng.randrange(60)}" for _ in range(600))) for i in range(100)]
    texts = [items[i][1][200:600] + " x y z" for i in range(0, 100, 9)] + [" ".join(f"v{rng.randrange(60)}" for _ in range(3000))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.item_windows(bench).count() > 50_000
    rows = decontam.report(documents(spark, texts), bench, broadcast_rows=1000).orderBy("doc_id").collect()
    wins = {}
    for i, t in items:
        w = t.split()
        for k in range(len(w) - 12):
            wins.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    for r, t in zip(rows, texts, strict=True):
        w = t.split()
        at = [k for k in range(len(w) - 12) if tuple(w[k : k + 13]) in wins]
        hit = {j for k in at for j in range(k, k + 13)}
        assert (r["n_words"], r["n_hit"]) == (len(w), len(hit))
        assert r["items"] == sorted({i for k in at for i in wins[tuple(w[k : k + 13])]})


def test_very_long_texts_made_of_passages(spark):
    """Hits carry their block and not their text: 20,000 and 200,000 words of passages stay small."""
    rng = random.Random(9)
    words = [f"v{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(2000))
    items = [(1, passage), (2, "a short item")]
    texts = [" ".join([passage] * 10), " ".join([passage] * 100), "a short item " * 6000, "x " * 20000, passage + " clean" * 500]
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.report(docs, bench).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows] == [(20000, 20000, ["1"], True),
        (200000, 200000, ["1"], True), (18000, 18000, ["2"], True), (20000, 0, [], False), (2500, 2000, ["1"], True)]
    assert [r["doc_id"] for r in decontam.decontaminate(docs, bench).collect()] == [3]
    left = {r["doc_id"]: r["n"] for r in decontam.remove_spans(docs, bench).selectExpr("doc_id", "size(clean_words) n").collect()}
    assert left == {0: 0, 1: 0, 2: 0, 3: 20000, 4: 500}

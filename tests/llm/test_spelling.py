import random
import re
import zlib
from collections import Counter

import pytest

from adsift.llm import spelling


UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_of(rows, slip=97, least=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, **options):
    words = words_of(rows, **options)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def table(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("abc", 2), ("aéß", 3), ("abcdefgh", 4)])
def test_against_all_pairs(spark, docs, alphabet, seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9))) for _ in range(12)]
    rows = []
    for i in range(150):
        made = []
        for _ in range(12):
            w = rng.choice(stems[: rng.randint(1, 12)])
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(("", rng.choice(alphabet), w[at] + rng.choice(alphabet))) + w[at + 1 :]
            made.append(w)
        rows.append((i, " ".join(made)))
    got = table(spelling.group(docs(rows)))
    assert got == brute(rows)
    assert len(got) > 20 and any(r[4] > 1 for r in got)


def test_chains_of_forms_ties_and_case(spark, docs):
    rows = [(1, "abcde " * 3 + "abcdx " * 6 + "abcyx " * 12 + "abzyx " * 24 + "ABCDE! " * 0),
            (2, "Other " * 8 + "Othex " * 8 + "othez " * 4), (3, "Ünder " * 4 + "Únder " * 9), (4, None), (5, ""), (5, "tiny"), (None, "Other")]
    got = table(spelling.group(docs(rows), slip=1 << 40))
    assert got == brute(rows, slip=1 << 40)
    told = {r[0]: r for r in got}
    assert told["abcde"][2] == "abzyx" and told["abcde"][1] == "abcdx"
    assert told["othez"][1] == "other" and told["Ünder"][1] == "Únder"


def test_long_text_repeated_rows_and_clashing_columns(spark):
    rows = [(7, "letter lettre " * 50_000, "w", 1)] * 2 + [(8, "letter", "w", 2), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    assert table(spelling.group(df)) == brute([r[:2] for r in rows])
    assert table(spelling.group(df.limit(0))) == []
    assert table(spelling.group(df.where("doc_id = 8"))) == []


def test_pivots_are_disjoint_and_rare(spark):
    words = spark.createDataFrame([("aaaaa", 3), ("abababab", 3), ("abcde", 4), ("zzabzz", 3)], "word string, n long")
    weight = {r["gram"]: (r["weight"], r["rank"]) for r in spelling.gram_order(words).collect()}
    for r in spelling.gram_prefixes(words, spelling.gram_order(words)).collect():
        grams = sorted((weight[r["word"][i : i + 2]][1], i) for i in range(len(r["word"]) - 1))
        assert r["last"] == grams[2][0]
        assert sorted((g["rank"], g["place"]) for g in r["prefix"]) == [g for g in grams if g[0] <= grams[2][0]]
        rarest = [(i, weight[r["word"][i : i + 2]][0]) for _, i in grams[:3]]
        least = min(x[1] + y[1] for x in rarest for y in rarest if abs(x[0] - y[0]) >= 2)
        a, b = r["pivots"]
        assert abs(a["place"] - b["place"]) >= 2 and a["weight"] + b["weight"] == least


def test_short_words_are_refused(spark, docs):
    with pytest.raises(ValueError):
        spelling.group(docs([(1, "x")]), least_chars=3)
    with pytest.raises(ValueError):
        spelling.group(docs([(1, "x")]), ratio=1)
    assert [tuple(r) for r in spelling.count_words(docs([(1, "abc " * 3)]), least_chars=3).collect()] == [("abc", 3)]

"""Learned dictionaries and best paths against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from adsift.operators import matching as M
from adsift.operators import segment as SG

HAN = "山水火木金土日月"


def plain_dictionary(texts, longest, least_count, least_entropy):
    count, beside = Counter(), {"L": defaultdict(Counter), "R": defaultdict(Counter)}
    for text, w in texts:
        for run in re.findall(r"[一-鿿]+", text or ""):
            for i in range(len(run)):
                for j in range(i + 1, min(i + longest, len(run)) + 1):
                    word = run[i:j]
                    count[word] += w
                    beside["L"][word][run[i - 1] if i else None] += w
                    beside["R"][word][run[j] if j < len(run) else None] += w

    def entropy(word, side):
        n = count[word]
        return math.log(n) - sum(c * math.log(c) for ch, c in beside[side][word].items() if ch is not None) / n

    words = {w: n for w, n in count.items()
             if len(w) == 1 or (n >= least_count and min(entropy(w, "L"), entropy(w, "R")) >= least_entropy)}
    total = sum(words.values()) or 1
    return {w: (n, round(math.log(total / n) * 1000)) for w, n in words.items()}, round(math.log(total / 0.5) * 1000)


def plain_path(run, costs, unknown, longest):
    best = [(0, 0, [])]
    for e in range(1, len(run) + 1):
        ways = []
        for n in range(1, min(longest, e) + 1):
            word = run[e - n : e]
            cost = costs.get(word, unknown if n == 1 else None)
            if cost is not None:
                ways.append((best[e - n][0] + cost, n, best[e - n][2] + [word]))
        best.append(min(ways, key=lambda x: x[:2]))
    return best[-1][2]


def texts(seed, n=200):
    rng = random.Random(seed)
    words = ["".join(rng.choice(HAN) for _ in range(rng.randint(1, 4))) for _ in range(12)]
    out = {}
    for _ in range(n):
        text = "".join(rng.choice(words) for _ in range(rng.randint(0, 5)))
        at = rng.randint(0, len(text))
        out[text[:at] + rng.choice(["", "", " ", "v12", "，"]) + text[at:]] = rng.randint(1, 9)
    return sorted(out.items())


@pytest.mark.parametrize("seed,longest", [(1, 4), (2, 3), (3, 2), (4, 1)])
def test_dictionary_and_paths(spark, seed, longest):
    log = texts(seed)
    df = spark.createDataFrame(log, "t string, cnt bigint")
    learned = SG.learn_words(df, "t", "cnt", longest=longest, least_count=6, least_entropy=0.45)
    want, unknown = plain_dictionary(log, longest, 6, 0.45)
    assert {r["word"]: (r["n"], r["cost"]) for r in learned.words.collect()} == want
    assert learned.unknown == unknown
    asked = sorted({r for t, _ in texts(seed + 100) for r in re.findall(r"[一-鿿]+", t)} | {"天", "山天水", "山" * 40})
    got = {r["run"]: r["words"] for r in SG.best_paths(spark.createDataFrame([(x,) for x in asked], "run string"), learned).collect()}
    costs = {w: c for w, (_, c) in want.items()}
    assert got == {x: plain_path(x, costs, unknown, longest) for x in asked}
    assert all("".join(words) == run for run, words in got.items())
    if longest > 2:
        assert any(len(w) > 1 for words in got.values() for w in words)


def test_words_of_texts(spark):
    log = spark.createDataFrame([("山水" + c, 9) for c in "火木金"] + [(c + "山水", 9) for c in "火木金"], "t string, cnt bigint")
    learned = SG.learn_words(log, "t", "cnt", least_count=20)
    df = spark.createDataFrame([(1, "山水v1 火 山水"), (2, None), (3, ""), (4, "abc 12"), (5, "，。"), (1, "山水v1 火 山水")], "id int, t string")
    got = sorted((r["id"], None if r["w"] is None else sorted(r["w"])) for r in SG.with_words(df, "t", "w", learned).collect())
    assert got == [(1, ["v1", "山水", "火"]), (1, ["v1", "山水", "火"]), (2, None), (3, []), (4, ["12", "abc"]), (5, [])]
    empty = SG.learn_words(df.limit(0).select("t"), "t")
    assert empty.words.collect() == []
    assert sorted(SG.with_words(df.where("id = 1").limit(1), "t", "w", empty).first()["w"]) == ["v1", "山", "水", "火"]


def test_long_run(spark):
    run = "".join(HAN[i * i % 8] for i in range(3000))
    learned = SG.learn_words(spark.createDataFrame([(run,)], "t string"), "t")
    got = SG.best_paths(spark.createDataFrame([(run,)], "run string"), learned).first()["words"]
    costs = {r["word"]: r["cost"] for r in learned.words.collect()}
    assert got == plain_path(run, costs, learned.unknown, SG.LONGEST)


def test_matching_on_words(spark):
    log = spark.createDataFrame([("山水" + c, 9) for c in "火木金"] + [(c + "山水", 9) for c in "火木金"], "search_word string, cnt bigint")
    bids = spark.createDataFrame([("水山",), ("山水",), ("木",), ("天",)], "bid_word string")
    cfg = M.MatchConfig(token_mode="lattice", words=SG.learn_words(log, "search_word", "cnt", least_count=20))
    got = {tuple(r) for r in M.word_pairs(log, bids, cfg).collect()}
    want = set()
    for c in "火木金":
        for q in ("山水" + c, c + "山水"):
            want |= {(q, "山水", 2), (q, "山水", 3)}
            if c == "木":
                want |= {(q, "木", 2), (q, "木", 3)}
    assert got == want
    with pytest.raises(ValueError):
        M.token_include(log, bids, M.MatchConfig(token_mode="lattice"))

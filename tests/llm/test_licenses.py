import random
import re

from adsift.llm import licenses

WORD = re.compile(licenses.WORD)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, templates, threshold):
    words = WORD.findall(lower(text))
    starts = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split(" ")
        starts += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    told = {}
    for line in lower(text).split("\n"):
        block = set(WORD.findall(line))
        for label, notice in templates:
            t = set(WORD.findall(lower(notice)))
            if t and len(block & t) >= licenses.need(len(t), threshold):
                told[label] = max(told.get(label, 0), len(block & t) / len(t))
    base = {label for _, label in starts}
    return (len(words), len(starts), min((i for i, _ in starts), default=None), max((i for i, _ in starts), default=None),
            ",".join(sorted(base)), ",".join(sorted(base | set(told))), 1.0 if starts else max(told.values(), default=0.0))


def run(docs, texts, **options):
    out = licenses.label_documents(*licenses.scan(docs([(i, t) for i, t in enumerate(texts)]), **options)).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return {r["doc_id"]: tuple(r[n] for n in names) for r in out}


def test_against_brute_force(docs):
    rng = random.Random(1)
    pool = sorted({w for _, n in licenses.TEMPLATES for w in WORD.findall(lower(n))}) + ["x1", "ä", "Zz"]
    texts = ["", None, "\n\n", "CC-BY cc by CC  by", "cc\nby", "All Rights Reserved. all rights reserved", "GENERAL public\nlicense",
             "Licensed under the Apache License, Version 2.0.", "the Apache License under version 2.0 licensed", "Released under the MIT License.",
             "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.\nfoo", "ccby", "É cc by é",
             "word " * 30000 + "cc by"]
    texts += ["\n".join(" ".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(4)) for _ in range(150)]
    for threshold in (0.9, 0.6):
        out = run(docs, texts, threshold=threshold)
        for i, text in enumerate(texts):
            assert out[i] == brute(text, licenses.TEMPLATES, threshold), (i, threshold)


def test_no_rows_and_no_templates(docs):
    assert run(docs, []) == {}
    assert run(docs, ["cc by", "x"], templates=(("none", "..."),)) == {0: (2, 1, 0, 0, "cc-by", "cc-by", 1.0), 1: (1, 0, None, None, "", "", 0.0)}


def test_repeated_rows_and_ids(docs):
    table = docs([(1, "cc by"), (1, "cc by"), (None, "all rights reserved")])
    out = licenses.label_documents(*licenses.scan(table)).collect()
    assert sorted((str(r["doc_id"]), r["base_labels"]) for r in out) == [("1", "cc-by"), ("1", "cc-by"), ("None", "reserved")]


WRAPPED = {
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files "
           "(the \"Software\"), to deal\n# in the Software without restriction, including without limitation the rights\n# to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell\n# copies of the Software, and to permit persons to whom the Software is\n# furnished to do so, "
           "subject to the following conditions:",
    "gnu-gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as "
               "published by\n * the Free Software Foundation, either version 2 of the License, or\n * (at your option) any later version.",
}


def test_wrapped_notices_at_every_offset(docs):
    """Found wherever they start, and nothing else is; lines alone don't hold them."""
    labels = sorted(WRAPPED)
    texts = ["w " * at + "\n" + WRAPPED[label] + "\n" + "v " * 300 for label in labels for at in range(0, 150, 7)]
    texts += ["subject to the terms " * 50, "", None]
    out = run(docs, texts, across=licenses.TEMPLATES + licenses.NOTICES)
    want = [label for label in labels for _ in range(0, 150, 7)] + [""] * 3
    assert [",".join(x for x in out[i][5].split(",") if x != "gpl") for i in range(len(texts))] == want
    assert all(out[i][6] >= licenses.THRESHOLD for i in range(len(texts) - 3))
    alone = run(docs, texts)
    assert not any({"mpl-2.0", "bsd", "mit", "gnu-gpl"} & set(alone[i][5].split(",")) for i in range(len(texts)))


def test_windows_against_brute_force(docs):
    """Threshold 0.6, so that many windows meet and many fall short."""
    rng, across = random.Random(3), licenses.TEMPLATES[:6]
    pool = sorted({w for _, n in across for w in WORD.findall(n)}) + ["x1", "y"]
    texts = ["\n".join(" ".join(rng.choice(pool) for _ in range(3)) for _ in range(rng.randint(0, 20))) for _ in range(100)]
    out = run(docs, texts, templates=(), phrases=(("zz", "zz"),), threshold=0.6, across=across)
    some = 0
    for i, text in enumerate(texts):
        words, told = WORD.findall(lower(text)), {}
        for label, notice in across:
            t, span = set(WORD.findall(notice)), licenses.span_of(notice)
            for at in range(0, len(words), span):
                n = len(t & set(words[at : at + 2 * span]))
                if n >= licenses.need(len(t), 0.6):
                    told[label] = max(told.get(label, 0), n / len(t))
        some += bool(told)
        assert (out[i][5], out[i][6]) == (",".join(sorted(told)), max(told.values(), default=0.0)), i
    assert 10 < some < 100

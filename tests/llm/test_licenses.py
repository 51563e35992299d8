import math
import random
import re

from loadkit.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    """Base columns by brute force."""
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for label, phrases in licenses.BASE.items():
        for p in phrases:
            p = p.split()
            here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            starts += here
            labels |= {label} if here else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_and_labels(docs):
    texts = [
        None, "", "...", "MIT License", "the MIT-License, mit license mit license", "mitlicense MIT  licenses", "Licensed under the Apache License, Version 2.0.", "apache\nlicense",
        "This work is licensed under the GNU General Public License, version 3.", "general public mit license", "MIT LicenKe", "éMIT License", "MIT Licenſe", "général public license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "hereby granted to any person", "free software and a copy of the source",
        "word " * 50_000 + "MIT License. " * 3_000, "\x80 mit license 　mit license",
    ]
    rows = {r.doc_id: r for r in licenses.scan(docs(texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert base(rows[i]) == plain(t), t and t[:60]
        assert set(filter(None, rows[i].base_labels.split(","))) <= set(rows[i].labels.split(","))
        assert 0 <= rows[i].score <= 1
    assert rows[6].labels == "apache,apache-2" and rows[8].labels == "gpl,gpl-3" and rows[14].labels == "mit-notice" and rows[14].score == 1
    assert rows[15].labels == rows[16].labels == rows[0].labels == ""


def plain_labels(texts, templates=licenses.TEMPLATES, share=0.7):
    """Labels and scores straight from the definition: every alignment of every template, every file."""
    files = [WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    weight = lambda w: math.log((len(files) + 1) / (sum(w in f for f in files) + 0.5))
    indexed = {t.label: [(i, w, weight(w)) for i, w in enumerate(t.text.split()) if w not in licenses.COMMON] for t in templates}
    out = []
    for words in files:
        spoken, named = f" {' '.join(words)} ", {}
        for t in templates:
            total = sum(x for *_, x in indexed[t.label])
            shares = [sum(x for i, w, x in indexed[t.label] if 0 <= at + i < len(words) and words[at + i] == w) / total for at in range(-len(t.text.split()), len(words))] if total else []
            if max(shares, default=0) >= share - 1e-12 and all(f" {p} " in spoken for p in t.phrases):
                named[t.label] = max(shares)
        out.append((set(named), max(named.values(), default=0.0)))
    return out


def test_labels_and_scores_against_brute_force(docs):
    """Notices with words changed, dropped, repeated and set apart, so that shares lie on both sides of the bound."""
    source = random.Random(9)
    texts = ["", None, "plain words stand here"]
    for _ in range(120):
        words = []
        for t in source.choices(licenses.TEMPLATES, k=source.randint(1, 3)):
            given = t.text.split()
            changed = [source.choice([w.upper(), "other", f"{w} {w}", ""]) if source.random() < source.choice([0.0, 0.1, 0.25, 0.4]) else w for w in given]
            words += source.choices(["some", "plain", *given, *t.phrases], k=source.randint(0, 6)) + changed
        texts.append(" ".join(words))
    rows = {r.doc_id: r for r in licenses.scan(docs(texts)).collect()}
    some = 0
    for i, (labels, score) in enumerate(plain_labels(texts)):
        r = rows[i]
        assert set(filter(None, r.labels.split(","))) - set(r.base_labels.split(",")) == labels - set(r.base_labels.split(",")), texts[i]
        assert abs(r.score - score) < 1e-9, texts[i]
        some += 0.7 <= score < 0.999
    assert some > 20


def test_rare_words_cover_every_share():
    """What holds none of a template's rare postings cannot reach the share."""
    postings, words = licenses._index(licenses.TEMPLATES)
    source = random.Random(3)
    for share in (0.5, 0.7, 0.9):
        index = licenses.weighted(postings, {w: source.random() for w in words}, share)
        for label in {x[1] for x in index}:
            own = [x for x in index if x[1] == label]
            assert sum(x[3] for x in own if not x[4]) < share and abs(sum(x[3] for x in own) - 1) < 1e-9


def test_notice_without_its_rarest_word(docs):
    rest = "and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    texts = [f"redistributing {rest} see redistribution below", f"using {rest}", f"using {rest}"] + ["plain words"] * 50
    rows = {r.doc_id: r for r in licenses.scan(docs(texts)).collect()}
    assert rows[0].labels == rows[1].labels == "bsd" and 0.7 <= rows[0].score < 1


def test_odd_rows(spark):
    rows = [(None, "MIT License", 1, "z"), (1, "mit license", 2, None), (1, "mit license", 2, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int, places string")
    got = licenses.scan(frame).collect()
    assert sorted((r.doc_id or -1, r.n_base, r.labels) for r in got) == [(-1, 1, "mit"), (1, 1, "mit"), (1, 1, "mit")]
    assert licenses.scan(frame.limit(0)).count() == 0


def test_query(spark):
    from loadkit.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_licenses"](spark, folder).collect()
    assert {r.doc_id: base(r) for r in rows} == {k: plain(t) for k, t in texts.items()}
    assert any(r.labels != r.base_labels for r in rows)

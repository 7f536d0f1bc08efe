import re
import textwrap

from tablelog.llm import licenses
from tests.llm.conftest import ODD

S = licenses.SENTENCES


def scan(documents, texts, **options):
    got = licenses.scan_licenses(documents(list(enumerate(texts))), **options).collect()
    return [list(r["licenses"]) for r in sorted(got, key=lambda r: r["doc_id"])]


def test_every_rule(documents):
    texts = [" ".join(S[i] for i in ids) for _, ids in licenses.RULES]
    assert scan(documents, texts) == [[name] for name, _ in licenses.RULES]


def test_lines_wrapped_and_loud(documents):
    mit = f"{S['mit-grant']}\n\n{S['mit-notice']}"
    wrapped = re.sub(r"((?:\S+ ){9})", r"\1\n   * ", mit)
    texts = [
        f"Some prose without an end\n{S['apache-line']}\nmore prose",
        f"Copyright 2020 A. Person\n\n{mit.upper()}\n\nTHE SOFTWARE IS PROVIDED AS IS.",
        f"First words. {wrapped}",
        f"{S['mit-line']} And here: {S['cc-by-nc4-line']}\n{S['mit-line']}",
    ]
    assert scan(documents, texts) == [["Apache-2.0"], ["MIT"], ["MIT"], ["CC-BY-NC-4.0", "MIT"]]


def test_longer_rules_use_up_their_sentences(documents):
    three = " ".join(S[f"bsd-{x}"] for x in ("grant", "source", "binary", "names"))
    two = " ".join(S[f"bsd-{x}"] for x in ("grant", "source", "binary"))
    assert scan(documents, [three, two, f"{three} {two}", f"{S['bsd-source']} {S['bsd-grant']}"]) == [
        ["BSD-3-Clause"],
        ["BSD-2-Clause"],
        ["BSD-2-Clause", "BSD-3-Clause"],
        [],
    ]


def commented(text, mark, width=60):
    return "\n".join(f"{mark} {x}".rstrip() for p in text.split("\n") for x in textwrap.wrap(p, width) or [""])


def test_commented_headers(documents):
    bsd = "\n\n".join([S["bsd-grant"], f"1. {S['bsd-source']}", f"2. {S['bsd-binary']}", f"3. {S['bsd-names']}"])
    gpl = f"{S['gpl-free']}\n\n{S['gpl-hope']} {S['gpl-fitness']}"
    notices = {"MIT": f"{S['mit-grant']}\n\n{S['mit-notice']}", "ISC": S["isc-grant"], "BSD-3-Clause": bsd, "GPL-3.0-or-later": gpl}
    for head in ("Copyright (c) 2020 Foo\n\n", "Copyright (c) 2020 Foo\n"):
        texts = [commented(head + x, mark) + "\ncode()" for x in notices.values() for mark in ("#", "//", " *", "--")]
        assert scan(documents, texts) == [[name] for name in notices for _ in range(4)]


def test_wrapped_and_single_lines_in_one_text(documents):
    wrapped = "\n".join(textwrap.wrap(S["isc-grant"], 50))
    lines = f"no end\n{S['apache-line']}\nno end here\n{S['mit-line']}\nnone"
    more = "\n\n".join("\n".join(textwrap.wrap(S[x], 40)) for x in ("gpl2-free", "mpl2", "unlicense"))
    texts = [f"{wrapped}\n\n{lines}", f"{lines}\n\n{wrapped}", f"{lines}\n{wrapped}", f"{more}\n\nno end\n{S['mit-line']}"]
    every = ["Apache-2.0", "ISC", "MIT"]
    assert scan(documents, texts) == [every, every, every, ["GPL-2.0-or-later", "MIT", "MPL-2.0", "Unlicense"]]
    # The longer reading of a place counts.
    assert scan(documents, ["Licensed under the Apache License, Version 2.0\n(the \"License\");"]) == [[]]


def test_no_rule_over_other_sentences(documents):
    two = [S["mit-grant"], S["mit-notice"]]
    own = dict(sentences={"a": "Take it.", "b": "Leave it!"}, rules=[("TL", ["a", "b"])])
    assert scan(documents, [f"{two[0]}\n\nA story of dogs. It goes on.\n\n{two[1]}", f"{two[0]}\n\n2.\n\n{two[1]}"]) == [[], ["MIT"]]
    assert scan(documents, ["Take it. But why? Leave it!", "Take it. -- Leave it!", "Take it.\nand\nLeave it!"], **own) == [[], ["TL"], []]


def test_part_of_a_sentence_is_none(documents):
    assert scan(documents, ["I was released under the MIT License.", "MIT License", "licensed under cc by", "License"]) == [[], [], [], []]


def test_own_rules(documents):
    own = dict(sentences={"a": "Take it.", "b": "Leave it!"}, rules=[("T", ["a"]), ("TL", ["a", "b"])])
    assert scan(documents, ["take IT. leave it!", "Take it.", "Leave it! Take it."], **own) == [["TL"], ["T"], ["T"]]
    assert scan(documents, ["take it."], sentences={}, rules=[]) == [[]]


def test_odd_rows(documents):
    got = licenses.scan_licenses(documents(ODD)).collect()
    assert len(got) == len(ODD) and not any(r["licenses"] or r["sentences"] for r in got)
    df = licenses.scan_licenses(documents(ODD).filter("false"))
    assert df.count() == 0
    assert not re.search("Python|Pandas|MapInArrow", df._jdf.queryExecution().toString())


def test_triggers_cover_all_sentences():
    known, _ = licenses._known(S)
    words = licenses._triggers(list(known))
    assert all(any(w in x for w in words) for x in known) and len(words) < len(known)


def brute(text, sentences, rules):
    """Sentences and licences of one text, place by place."""
    known, parts = licenses._known(sentences)
    low = "".join(c.lower() if c.isascii() else c for c in text).replace("\x01", " ")
    # Words with what stands before each: 0 nothing but signs, 1 a line end, 2 the end of a sentence.
    words, before, cut = [], [], 2
    lines = low.split("\n")
    for i, line in enumerate(lines):
        if i:
            cut = max(cut, 1)
        if 0 < i < len(lines) - 1 and not re.search("[a-z0-9\x80-\U0010ffff]", line):
            cut = 2
        for m in re.finditer("([a-z0-9\x80-\U0010ffff]+)|([.;:!?])(?=[\\s\"')]|$)", line + ("" if i == len(lines) - 1 else "\n")):
            if m.group(1):
                words.append(m.group(1))
                before.append(cut)
                cut = 0
            else:
                cut = 2
    before.append(2)
    sequence, at, other = [], 0, False
    by_length = sorted((x.split() for x in known), key=len, reverse=True)
    by_length.sort(key=lambda x: -len(" ".join(x)))
    while at < len(words):
        for x in by_length if before[at] else []:
            to = at + len(x)
            if words[at:to] == x and before[to] and 2 not in before[at + 1 : to]:
                sequence += ([None] if other and sequence else []) + [known[" ".join(x)]]
                at, other = to, False
                break
        else:
            alone = before[at] and before[at + 1] and re.fullmatch(licenses.NUMBER, words[at])
            other = other or not alone
            at += 1
    found, rest = set(), list(sequence)
    for name, ids in sorted(((n, [i for x in ids for i in parts[x]]) for n, ids in rules), key=lambda x: -len(x[1])):
        i = 0
        while i + len(ids) <= len(rest):
            if rest[i : i + len(ids)] == ids:
                found.add(name)
                rest[i : i + len(ids)] = [False]
            i += 1
    return [x for x in sequence if x], sorted(found)


def test_brute_force(documents):
    import random

    rng = random.Random(21)
    names = list(S)
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 6)):
            x = rng.choice([S[rng.choice(names)], S[rng.choice(names)], "Some other words here.", "no end", "2.", "iv", " ".join(S[i] for i in rng.choice(licenses.RULES)[1])])
            if rng.random() < 0.3:
                x = "\n".join(textwrap.wrap(x, rng.choice([20, 40, 70])))
            if rng.random() < 0.2:
                x = x.upper()
            if rng.random() < 0.1:
                x = x.replace(" ", "  ", 2).rstrip(".")
            parts.append(x)
        text = parts[0]
        for x in parts[1:]:
            text += rng.choice([" ", "\n", "\n\n", "\n#\n", " -- ", "\n * "]) + x
        texts.append(commented(text, rng.choice(["#", "//"])) if rng.random() < 0.2 else text)
    got = licenses.scan_licenses(documents(list(enumerate(texts)))).collect()
    for r in got:
        want = brute(texts[r["doc_id"]], S, licenses.RULES)
        assert (list(r["sentences"]), list(r["licenses"])) == want, texts[r["doc_id"]]
    assert sum(bool(r["licenses"]) for r in got) > 100

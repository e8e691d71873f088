"""Small tables with every awkward case, and brute-force versions of the operators."""

import re
from collections import Counter, defaultdict

import public_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

LONG = "word " * 30_000 + "x" * 20_000
ODD = ["", "a\x1cb  c\u0085d \n\n é é ́x", "<|endoftext|> x<|startoftext|>y <|end", "İstanbul ΣΑΣ ﬁ Straße 12345 don't I'LL",
       "日本語 テキスト\U0001f642 a\U0001f642b", "\t tab\r\nline \x0b\x0c", "'s 's's ''s", "ÀÉß×÷ø ÿ", "<| <|| a<|b", "  a b　c", "ab­c ​ d﻿"]


def awkward_documents(spark):
    """Null ids and texts, repeated rows, an id with two texts, an empty and a very long text, and columns whose names
    operators might use themselves."""
    rows = [(1, "one two three four five six seven", "en", "a"), (1, "one two three four five six seven", "en", "a"),
            (2, None, "en", None), (3, "", None, "a"), (None, "a null id", "en", "a"), (None, None, None, None),
            (4, "one two three four five six seven", "de", "b"), (5, "x", "en", "a"), (5, "another text under one id", "en", "a"),
            (6, " \n\t ", "en", "a"), (7, LONG, "en", "a"), *[(10 + i, t, "en", "odd") for i, t in enumerate(ODD)]]
    names = ["id", "n", "part", "ids", "score", "kept", "key", "bin", "_text", "_q", "_row", "component", "length"]
    made = [(*r, *([f"own {k}" for k in range(len(names))])) for r in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))


def empty_like(df):
    return df.limit(0)


def shingles(text):
    words = WORDS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    k = min(5, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def groups(ids, links):
    """Smallest id reachable from each id."""
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {i: find(i) for i in ids}


def brute_force_duplicates(texts):
    """``{id: (shingles, component)}`` of ``{id: text}``."""
    sets = {i: shingles(t) for i, t in texts.items()}
    at = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            at[g].append(i)
    shared = Counter((a, b) for v in at.values() for x, a in enumerate(v) for b in v[x + 1:])
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    top = groups(sets, links)
    return {i: (len(sets[i]), top[i]) for i in sets}

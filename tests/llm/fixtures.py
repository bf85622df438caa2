"""Small tables with the awkward cases, and plain versions of the operators."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASH = ("score", "slot", "shard", "item", "set_key", "unit", "n", "key", "part", "row", "piece", "kept", "component_id")


def prose(rnd, n, vocabulary=400):
    out = []
    while len(out) < n:
        line = [f"w{rnd.randrange(vocabulary)}{rnd.choice(['', ',', 'é'])}" for _ in range(rnd.randint(4, 14))]
        out += [line[0].capitalize(), *line[1:-1], line[-1] + rnd.choice([".", ".\n", "!\n\n"])]
    return " ".join(out[:n])


def rows(seed=7):
    """(doc_id, text): prose, near copies, a shared passage, and odd texts."""
    rnd = random.Random(seed)
    texts = [prose(rnd, rnd.randint(1, 160)) for _ in range(60)]
    passage = prose(rnd, 60)
    for k in range(12):  # near copies: a changed word here and there
        words = texts[3].split(" ") if k % 2 else texts[8].split(" ")
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [prose(rnd, 20) + " " + passage + " " + prose(rnd, 25) for _ in range(8)]
    texts += [None, "", " \n\t ", "one", "two words", "a b c d", "A B C D", "a b c d", texts[5], texts[5],
              "x  y\n\nz \n\nq 　w don't 3.5%--", "日本語 テキスト、です。", "<|endoftext|> end",
              prose(rnd, 6000), "word " * 3000, "longword" * 300]
    return list(enumerate(texts))


def documents(spark, data, clash=True):
    from pyspark.sql import functions as F
    full = [(i, t, ("en", "fr", None, "xx")[(i or 0) % 4], f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in data]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit(1) for c in CLASH}) if clash else df


def shingles(text, width=5):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}

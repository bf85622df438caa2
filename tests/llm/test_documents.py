"""The operators on documents against plain versions, on awkward tables."""

import hashlib
import itertools
import os
import zlib
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import (byte_bpe, fertility, gam_quality, license_scan, packing, sharding, signature_join,
                            toxicity_kn)
from ledgerlens.llm import queries as Q
from tests.llm import fixtures as X

SF = "/root/testdata/sf0.1"
ROWS = X.rows()


@pytest.fixture(scope="module")
def docs(spark):
    return X.documents(spark, ROWS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return X.documents(spark, [])


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, a repeated id with another text, null ids."""
    return X.documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"),
                               (None, None), (5, None), (5, "")])


def test_near_duplicates(docs, empty, odd):
    sets = {i: X.shingles(t) for i, t in ROWS}
    links = [(i, j) for i, j in itertools.combinations(sets, 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert len(links) > 20
    want = X.components(sets, links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    assert signature_join.near_duplicates(empty).count() == 0
    out = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in signature_join.near_duplicates(odd).collect())
    assert out == [(-1, 0, -1), (-1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (5, 0, 5), (5, 0, 5)]
    kept = signature_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, ""), (1, "a b c d e f"), (5, ""), (5, "")]


def test_large_trees_and_long_sets(spark):
    """Many sets below common shingles: trees with nodes, several components,
    sets beyond the common bitmap size."""
    import random
    rnd = random.Random(3)
    base = X.prose(rnd, 30, 5000)
    data = [base + " " + X.prose(rnd, rnd.randint(3, 22), 5000) for _ in range(90)]
    long_text = X.prose(rnd, 1500, 5000).split(" ")
    for k in range(6):
        words = list(long_text)
        for _ in range(30 * k):
            words[rnd.randrange(len(words))] = f"e{rnd.random()}"
        data.append(" ".join(words))
    data = list(enumerate(data))
    sets = {i: X.shingles(t) for i, t in data}
    links = [(i, j) for i, j in itertools.combinations(sets, 2) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = X.components(sets, links)
    assert 3 < len(set(want.values())) < len(want)
    got = {r.doc_id: r.component_id for r in signature_join.near_duplicates(X.documents(spark, data)).collect()}
    assert got == want


def test_packing(docs, empty, odd):
    from tokenizers import Tokenizer
    path, size = P.path("byte_bpe_50k.json"), 512
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    packed = packing.pack(docs, path, size=size, with_ids=True, group=16)
    out = packed.collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in ROWS}
    for r in out:
        part = ids[r.doc_id][r.start: r.start + r.length]
        assert r.ids == part and len(part) == r.length <= size
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r.ids_crc32
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for i, parts in by.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(-(-len(ids[i]) // size)))
        assert sum(p[2] for p in parts) == len(ids[i]) and all(p[2] == size for p in parts[1:])
    assert by.keys() == ids.keys()
    full = {}
    for r in out:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in full.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts[:-1])]
        assert sum(n for _, n in parts) <= size
    plain = 1 + max(packing.best_fit([r.length for r in out], size)[0])  # all pieces in one place
    assert len(full) <= 1.1 * plain  # in tiny groups; in one group nothing is lost:
    assert packing.pack(docs, path, size=size).select("sequence_id").distinct().count() == plain
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert sum(map(len, whole.values())) == sum(map(len, ids.values()))
    assert packing.pack(empty, path).count() == 0
    assert packing.pack(odd, path).count() == 7


def test_packing_of_added_tokens(spark, tmp_path):
    """The query's ids are the library's, added tokens' strings included."""
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    end = "<|endoftext|>"
    data = list(enumerate(["a <|endoftext|> b", end, end + end, None, "", "plain text", f"x{end}'s\n {end}\n", "<|endoftext|", f" {end} ",
                           f"<|{end}|>é日", "word " * 300 + end + " word" * 900]))
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in data}
    docs = X.documents(spark, data)
    out = packing.pack(docs, path, size=512, with_ids=True, special=True).collect()
    assert {(r.doc_id, r.piece): r.ids for r in out} == {
        (i, k): x[a: a + n] for i, x in ids.items() for k, (a, n) in enumerate(packing.cut(len(x), 512))}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.start, r.length): r.ids_crc32 for r in Q.op2_residual_packing(spark, str(tmp_path)).collect()}
    assert got == {(i, 0, len(x)): zlib.crc32(b"".join(e.to_bytes(4, "little") for e in x)) for i, x in ids.items()}


def test_best_fit_is_tight():
    where, offset = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert max(where) == 1 and sorted(offset) == [0, 0, 5, 6, 8]
    assert packing.cut(2048, 2048) == [(0, 2048)] and packing.cut(2050, 2048) == [(0, 2), (2, 2048)]


def plain_base(text):
    words = X.WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if X.WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_fertility_rules(spark, docs, empty, odd):
    import math

    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in fertility.apply_rules(docs, path).collect()}
    for i, text in ROWS:
        r, base = got[i], plain_base(text)
        assert tuple(r[c] for c in fertility.BASE) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        ids = [t for w in X.WORD.findall(text or "") for t in model.encode(w)]
        n = Counter(ids)
        bits = -sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values()) if ids else 0.0
        share = sum(model.is_byte(t) for t in ids) / max(len(ids), 1)
        assert r.n_tokens == len(ids) and abs(r.token_entropy - bits) < 1e-9 and abs(r.fallback_share - share) < 1e-9
        band = fertility.BANDS[r.script]
        inside = (band.least_chars <= base[1] / max(len(ids), 1) <= band.most_chars and share <= band.most_fallback
                  and bits >= band.least_entropy)
        assert r.kept == (not r.base_failed and inside)
    kept = fertility.keep_passing(docs, path)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}
    assert fertility.apply_rules(empty, path).count() == 0 and fertility.apply_rules(odd, path).count() == 7
    assert fertility.apply_rules(docs.drop("lang"), path).count() == len(ROWS)
    tight = fertility.apply_rules(docs, path, bands={"en": fertility.Band(8, 9, 0, 9)})
    assert not any(r.kept for r in tight.join(docs.select("doc_id", "lang"), "doc_id").where("lang = 'en'").collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_fertility_floors_catch_bad_texts(spark):
    """The bands of a language, from its own texts, reject what the base rules let pass."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = Q.op3_tokeniser_fertility(spark, SF).persist()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = out.where("NOT base_failed").join(labels, "doc_id")
    share = {r.quality: r.lost for r in seen.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("lost")).collect()}
    assert share[0] > 0.4 and share[1] < 0.03
    path = P.path("piece_bpe_32k.model")
    limits = fertility.floors(fertility._traits(docs, path, "sentencepiece", frozenset(range(3, 259)), None, 50, 50, "text",
                                                "doc_id", "lang"), 0.05, 100).collect()
    assert {r.place for r in limits} == {f"lang {x}" for x in ("en", "fr", "de", "es")}
    for place in {r.place for r in limits}:
        rising = [r.floor_entropy for r in sorted(limits, key=lambda r: r.step) if r.place == place]
        assert rising == sorted(rising) and rising[-1] > rising[0]
    kept = fertility.keep_passing(docs, path, low=0.05)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out.where("kept").collect())


def test_shards(spark, docs, empty, odd):
    out = sharding.shard_documents(docs, shards=7, block=5).collect()
    assert sorted(r.doc_id for r in out) == [i for i, _ in ROWS]
    text = dict(ROWS)
    for r in out:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sharding.shard_documents(empty).count() == 0 and sharding.shard_documents(odd, shards=40).count() == 7


def test_shuffle_is_uniform(spark):
    """Each row is equally likely in each shard and slot, over seeds."""
    rows = spark.range(6, numPartitions=3)
    seen = Counter()
    n = 40
    for seed in range(n):
        for r in sharding.shuffle_rows(rows, 2, seed=seed, block=2).collect():
            seen[r.id, r.shard, r.slot] += 1
    expected = n / 6
    assert len(seen) == 36 and sum((c - expected) ** 2 / expected for c in seen.values()) < 60  # 25 degrees of freedom
    import numpy as np
    m = sharding.communication_matrix(np.array([5, 0, 7]), np.array([4, 4, 4]), 1)
    assert m.sum(1).tolist() == [5, 0, 7] and m.sum(0).tolist() == [4, 4, 4]


def test_matrix_of_billions_of_rows():
    import math

    import numpy as np
    rows, columns = np.array([6, 0, 30, 14, 50]) * 10 ** 8, np.array([33, 7, 40, 0, 20]) * 10 ** 8
    m = sharding.communication_matrix(rows, columns, 1)
    assert (m.sum(1) == rows).all() and (m.sum(0) == columns).all() and (m >= 0).all()
    share = np.outer(rows / rows.sum(), columns / columns.sum())
    spread = np.sqrt(rows.sum() * share * np.outer(1 - rows / rows.sum(), 1 - columns / columns.sum()))
    assert (abs(m - rows.sum() * share) <= 6 * spread + 1e-9).all() and (m != np.rint(rows.sum() * share)).any()
    rng = np.random.default_rng(5)  # the law itself, in halves down to single columns
    left, n, draws = np.array([3, 4, 0, 2]), 4, 6000
    seen = Counter(tuple(sharding.split(rng, left, n, below=0).tolist()) for _ in range(draws))
    want = {c: draws * math.prod(map(math.comb, left.tolist(), c)) / math.comb(9, n)
            for c in itertools.product(range(4), range(5), range(1), range(3)) if sum(c) == n}
    assert seen.keys() <= want.keys()
    assert sum((seen[c] - e) ** 2 / e for c, e in want.items()) < 2.5 * len(want)


def test_byte_bpe(docs, empty, odd):
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, text in ROWS:
        ids = encoding.encode_ordinary(text or "")
        want[i] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))
    for limit in (1 << 20, 20):  # most spans in the dictionary; most folded where they occur
        got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.round_trip(docs, path, P.PATTERN, limit=limit).collect()}
        assert got == want
    assert byte_bpe.round_trip(empty, path, P.PATTERN).count() == 0
    assert byte_bpe.round_trip(odd, path, P.PATTERN).count() == 7


def test_license_scan(spark, empty, odd):
    mit, apache = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["Apache-2.0"]
    header = license_scan.TEMPLATES["Apache-2.0-header"]
    changed = header.replace("may not use", "shall not use").replace("You may obtain a copy", "You may get one copy")
    data = [(0, "Some prose. " + mit + " More prose."), (1, "released UNDER\nthe (MIT) license!"), (2, "The license is nice."),
            (3, X.prose(__import__("random").Random(1), 900) + " é " + changed), (4, mit + " " + apache), (5, None), (6, ""),
            (7, (mit + "\n") * 400)]
    got = {}
    for r in license_scan.scan(X.documents(spark, data)).collect():
        got.setdefault(r.doc_id, []).append(r)
        assert data[r.doc_id][1][r.begin_char:r.end_char] == r.matched_text
    assert {k: sorted(x.license for x in v) for k, v in got.items() if k != 7} == {
        0: ["MIT"], 1: ["MIT"], 3: ["Apache-2.0-header"], 4: ["Apache-2.0", "MIT"]}
    assert len(got[7]) == 400 and got[0][0].coverage == 1.0 and 0.85 < got[3][0].coverage < 1.0
    assert license_scan.scan(empty).count() == 0 and license_scan.scan(odd).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(odd, templates={"short": "too short"})


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def _held_out(out, labels, column):
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert {zlib.crc32(str(r.doc_id).encode()) % 4 for r in rows} == {2}
    good, bad = [r for r in rows if r[column]], [r for r in rows if not r[column]]
    return sum(r.predicted for r in good) / len(good), sum(r.predicted for r in bad) / len(bad)


def test_quality_on_held_out_rows(spark, tables, empty, odd):
    docs, labels = tables
    kept, wrong = _held_out(gam_quality.score_quality(docs, labels), labels, "quality")
    assert kept >= 0.98 and wrong <= 0.15
    good = gam_quality.keep_good(docs, labels)
    scores = gam_quality.score_quality(docs, labels)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert gam_quality.score_quality(empty, labels).count() == 0
    out = gam_quality.score_quality(odd, labels).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in gam_quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}


def test_toxicity_on_held_out_rows(spark, tables, empty, odd):
    docs, labels = tables
    caught, wrong = _held_out(toxicity_kn.score_toxicity(docs, labels), labels, "toxic")
    assert caught >= 0.6 and wrong <= 0.05
    assert toxicity_kn.score_toxicity(empty, labels).count() == 0
    out = toxicity_kn.score_toxicity(odd, labels).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in toxicity_kn.score_toxicity(odd, labels.limit(0)).collect()} == {0.0}


def test_shared_counts_are_of_texts():
    """Other words count once a text each, as the words of the sample do."""
    import numpy as np
    import pyarrow as pa
    from ledgerlens.llm.textscan import Texts
    words, _ = toxicity_kn.word_hashes(Texts.of(pa.array(["known"])))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(
        ["known rare rare rare", "rare known Known odd rare", "", "odd"])], ["doc_id", "text"])
    (out,) = toxicity_kn._document_counts(iter([batch]), words)
    assert dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist())) == {0: 2, 1: 4}
    # The shared count of a word that neither class has seen leaves the ratio.
    rng = np.random.default_rng(3)
    seen = np.sort(rng.integers(1, 2 ** 60, 40).astype(np.uint64))
    toxic, ordinary = (toxicity_kn.fit_class([(w, toxicity_kn.windows(w, 2)) for w in (rng.choice(seen, 30) for _ in range(9))])
                       for _ in range(2))
    word = np.concatenate([rng.integers(2 ** 61, 2 ** 62, 20).astype(np.uint64), seen[:5]])
    before = np.concatenate([seen[:20], seen[5:10]])
    pair = toxicity_kn.windows(np.stack([before, word], 1).reshape(-1), 2)[::2]
    ratios = [toxicity_kn.Scorer(toxic, ordinary, seen, np.full(40, 0.01), rest).ratios(word, before, pair)
              for rest in (0.5, 1e-9)]
    assert np.allclose(*ratios)


def test_class_model_is_a_distribution():
    """Bigram probabilities over the vocabulary sum to one after a known word."""
    import numpy as np

    from ledgerlens.llm.textscan import mix, windows
    rng = np.random.default_rng(2)
    vocabulary = mix(np.arange(1, 31, dtype=np.uint64))
    texts = [vocabulary[rng.integers(0, 30, 40)] for _ in range(20)]
    model = toxicity_kn.fit_class([(w, windows(w, 2)) for w in texts])
    before = np.full(30, vocabulary[3])
    pairs = np.array([windows(np.array([vocabulary[3], w]), 2)[0] for w in vocabulary])
    p = model.likelihood(vocabulary, before, pairs, np.full(30, 1 / 30))
    assert abs(p.sum() - 1) < 1e-9

"""The text operators against brute force on small tables with awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from tallybridge.llm import bpe, dac, decontaminate, kernels, ngram_join, recompress, substrings
from tallybridge.llm.registry import tokenizer

tokenizers = pytest.importorskip("tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, owner string, bucket string, keys string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def texts():
    rng = np.random.default_rng(3)
    vocab = [f"{a}{b}" for a in "the of and reti ön été x! 日本".split() for b in ("", "er", "tion", ",")]
    make = lambda n: " ".join(rng.choice(vocab, n))
    base, passage = make(120), make(60)
    out = [None, "", " \t\n", "one", "a b c", "same same same same same same same same same same same same same same same same", base, base, base + " tail", base.upper(), base.replace("\x20", "\n", 3)]
    for i in range(12):
        words = base.split()
        for at in rng.integers(0, len(words), 1 + i % 4):
            words[at] = f"edit{i}"
        out.append(" ".join(words))
    out += [make(30) + " " + passage + " " + make(20) for _ in range(6)] + [make(int(n)) for n in rng.integers(1, 80, 30)] + [make(9000), "  ".join(["x"] * 40), "<|endoftext|> a<|endoftext|>", "tab\tsep  double \n end "]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i * 3, t, "en", f"src{i % 3}", len(t or ""), "clash", "clash", "clash") for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows + [rows[6]], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_and_windows_are_the_same_in_any_batch():
    some = [t or "" for t in texts()]
    for fold in (False, True):
        joined = kernels.words(np.frombuffer("".join(some).encode(), np.uint8), np.cumsum([0, *[len(t.encode()) for t in some]]), fold)
        apart = [kernels.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), fold).hashes for t in some]
        assert (joined.hashes == np.concatenate(apart)).all()
        assert np.diff(joined.first).tolist() == [len(WORD.findall(t)) for t in some]
        seen = collections.defaultdict(set)
        for t, h in zip(some, apart, strict=True):
            for w, x in zip(WORD.findall(lower(t) if fold else t), h.tolist(), strict=True):
                seen[w].add(x)
        assert all(len(v) == 1 for v in seen.values()) and len({x for v in seen.values() for x in v}) == len(seen)


def test_bpe_equals_the_library(docs, rows, empty):
    path = tokenizer("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, path).collect()}
    digests = {r["doc_id"]: r for r in bpe.digest_documents(docs, path).collect()}
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id]["ids"] == ids and got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["decoded"] == library.decode(ids, skip_special_tokens=False) == (text or "")
        assert digests[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_documents(empty, path).count() == 0 and bpe.digest_documents(docs, path).count() == len(rows) + 1


def test_bpe_on_odd_characters():
    import random

    path = tokenizer("byte_bpe_50k.json")
    library, ours = tokenizers.Tokenizer.from_file(path), bpe.load(path)
    random.seed(5)
    pieces = ["a", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "é", "²", "5", "<|endoftext|>", "!!", "日本", "🙂", "‍", "_", "\r\n", "İ"]
    for _ in range(3000):
        t = "".join(random.choice(pieces) for _ in range(random.randint(0, 12)))
        ids = library.encode(t, add_special_tokens=False).ids
        assert ours.encode(t).tolist() == ids and ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_token_files(docs, rows, empty, tmp_path):
    path = tokenizer("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = sorted(tuple(r) for r in dac.tokenise(docs, path, 2, out=str(tmp_path / "t")).collect())
    want, start = [], 0
    for doc_id, text, *_ in sorted(rows + [rows[6]], key=lambda r: r[0]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert dac.tokenise(empty, path, 2, out=str(tmp_path / "e")).count() == 0


def test_single_tokens_by_their_number(spark, docs, rows, tmp_path, monkeypatch):
    path = tokenizer("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    dac.write_shards(docs, str(tmp_path / "t"), path, 2, shard_ids=500)
    every = [i for r in sorted(rows + [rows[6]], key=lambda r: r[0]) for i in [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]]
    some = [*range(0, len(every), 7), len(every) - 1]
    for grid in (1 << 17, 64):
        monkeypatch.setattr(dac, "SHARD_IDS", grid)
        wanted = spark.createDataFrame([(i,) for i in [*some, some[1], len(every), -1, None]], "position long")
        assert {tuple(r) for r in dac.read_tokens(spark, str(tmp_path / "t"), wanted).collect()} == {(i, every[i]) for i in some}


def test_codes_give_random_access():
    ids = np.random.default_rng(1).integers(0, 1 << 32, 5000, dtype=np.uint64).astype(np.uint32) >> np.random.default_rng(2).integers(0, 32, 5000).astype(np.uint32)
    shard = dac.Shard(dac.pack(ids, np.array([0, 10, 10, 5000])))
    assert (shard.decode() == ids).all() and all(shard[i] == ids[i] for i in range(5000))
    assert [len(x) for x in shard.documents()] == [0, 10, 0, 4990]
    assert len(dac.Shard(dac.pack(ids[:0], np.array([0])))) == 0
    with pytest.raises(IndexError):
        shard[5000]


def brute_repeats(rows, window):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in sorted((r[0], r[1]) for r in rows)]
    for i, w in split:
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("window, rounds", [(13, 3), (5, 1), (13, 0)])
def test_substrings(spark, docs, rows, empty, window, rounds):
    want = brute_repeats(rows, window)
    got = substrings.remove_repeats(docs, window=window, rounds=rounds).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r["n_words"], r["n_removed"], r["kept"]) == want[r["doc_id"]]
    assert substrings.remove_repeats(empty).count() == 0
    none = spark.createDataFrame([(None, "a b " * 20, "", "", 0, "", "", ""), (1, "a b " * 20, "", "", 0, "", "", "")], SCHEMA)
    assert {(r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(none).collect()} == {(None, 0), (1, 0)}


def test_equal_windows_hold_equal_decided_symbols():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 12, 20_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    doc = np.sort(rng.integers(0, 200, len(words)))
    s = recompress.parse(kernels.mix(words), doc, 3)
    held = collections.defaultdict(set)
    for i in range(len(words) - 8):
        if doc[i] == doc[i + 7]:
            inside = np.flatnonzero((s.left >= i) & (s.right <= i + 8))
            held[words[i : i + 8].tobytes()].add(tuple((int(s.left[k]) - i, int(s.right[k]) - i, int(s.name[k])) for k in inside))
    assert all(len(v) == 1 for v in held.values())


def brute_components(rows, ngram, percent):
    sets = {}
    for doc_id, text, *_ in rows:
        w = WORD.findall(lower(text))
        sets[doc_id] = {tuple(w[i : i + ngram]) for i in range(len(w) - ngram + 1)} if len(w) >= ngram else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("ngram, percent", [(4, 85), (5, 80), (1, 60)])
def test_ngram_join(docs, rows, empty, ngram, percent):
    got = ngram_join.similar_components(docs, ngram=ngram, percent=percent).collect()
    assert len(got) == len(rows) + 1
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, ngram, percent)
    if percent == 85:
        assert ngram_join.similar_components(empty).count() == 0


@pytest.mark.parametrize("percent", [60, 85])
def test_signatures_meet_for_every_similar_pair(percent):
    """The pigeonhole: random pairs at the limit share a signature, with and without a list of frequent ones."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        keep = rng.permutation(len(a))[: max(1, int(np.ceil(len(a) * (percent / 100 if rng.random() < 0.5 else (1 + percent / 100) / 2))))]
        b = np.unique(np.append(a[keep], rng.integers(0, 1 << 62, int(rng.integers(0, 1 + n // 12))).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        if len(a) == both == len(b) or 100 * both < percent * (len(a) + len(b) - both):
            continue
        sign, of = ngram_join.signatures([a, b], percent, np.zeros(0, np.uint64))
        assert set(sign[of == 0].tolist()) & set(sign[of == 1].tolist())
        frequent = np.sort(rng.choice(sign, len(sign) // 2))
        sign, of = ngram_join.signatures([a, b], percent, frequent)
        assert set(sign[of == 0].tolist()) & set(sign[of == 1].tolist())


def test_groups_over_the_frequent_limit(monkeypatch, docs, rows):
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(docs).collect()}
    assert got == brute_components(rows, 4, 85)


def test_decontamination(spark, docs, rows, empty):
    full = [t for t in texts() if t]
    passage = WORD.findall(full[-10])[:25]
    items = [(1, " ".join(passage)), (2, None), (3, ""), (4, full[5][:60]), (5, "a b"), (6, "zz yy xx ww vv uu"), (1, " ".join(passage)), (7, full[5].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for doc_id, text, *_ in rows:
        words = WORD.findall(lower(text))
        for item, t in items:
            w = WORD.findall(lower(t))
            k = min(5, len(w))
            own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
            shared = len(own & {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}) if k else 0
            if own and shared >= 0.8 * len(own):
                want.add((doc_id, item, shared, len(own)))
    got = decontaminate.find_contained(docs, bench)
    assert {tuple(r) for r in got.collect()} == want and want
    assert {tuple(r) for r in decontaminate.find_contained(docs, bench, block_chars=40).collect()} == want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {w[0] for w in want}
    assert decontaminate.find_contained(empty, bench).count() == 0 and decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(rows) + 1

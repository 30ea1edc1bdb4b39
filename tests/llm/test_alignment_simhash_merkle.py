"""Operators 11 to 13 against brute force: tokens of the two libraries, all pairs of fingerprints, plain trees."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import duck, rows
from fixtures import TEXTS, docs

from sparkloom.llm import alignment, merkle, simhash

AWKWARD = [
    (20, " lead  two   x \n\n y"),
    (21, "▁x"),
    (22, "a\x00b "),
    (23, " "),
    (24, "日本語テキスト 混在 text한국어 ไทย nb"),
    (25, "ﬁ Ａ é é <s></s> <unk>"),
    (26, "x" * 3000 + " " + "y z" * 50),
    (27, "\n"),
    (28, "  "),
    (29, "😀👩‍👩‍👧 ok"),
]


# Token alignment


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text, a, b):
    """(ids, byte ranges) of both sides, or None where they do not give the text back."""
    if not text:
        return None
    letters = {v: k for k, v in enumerate(alignment.aligner(*alignment.paths(None, None)).a.encoder.letters)}
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return None
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    return [(i, list(zip([0, *e], e))) for i, e in zip(ids, ends)]


def aligned_plainly(listed):
    a, b = libraries()
    found, counts = [], Counter()
    for doc_id, text in listed:
        own = tokens(text, a, b)
        if own is None:
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        (ia, ra), (ib, rb) = own
        links, first = [], 0
        for k, (s, e) in zip(ia, ra):
            while rb[first][1] <= s:
                first += 1
            at = first
            while at < len(rb) and rb[at][0] < e:
                links.append((k, ib[at]))
                at += 1
        groups, i, j = [], 0, 0
        for end in sorted({e for _, e in ra} & {e for _, e in rb}):
            own_a, own_b = [], []
            while i < len(ra) and ra[i][1] <= end:
                own_a.append(str(ia[i]))
                i += 1
            while j < len(rb) and rb[j][1] <= end:
                own_b.append(str(ib[j]))
                j += 1
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
        counts.update(links)
        found.append((doc_id, len(ia), len(ib), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(n, best.get(j, 0))
    return [(i, na, nb, ng, len(l), sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l), h) for i, na, nb, ng, l, h in found], counts


def test_alignment_agrees_with_the_libraries(spark, sf_dir):
    listed = TEXTS + AWKWARD + [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()]
    want, counts = aligned_plainly(listed)
    got = alignment.alignment(docs(spark, listed), block=5000)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert {(r.a, r.b): r.n for r in alignment.pair_counts(docs(spark, listed)).collect()} == dict(counts)


def test_alignment_by_segments_is_that_of_the_whole():
    own = alignment.Aligner(*alignment.paths(None, None))
    rng = random.Random(4)
    text = " ".join(rng.choice(["word", "日本", "a\nb", "  x", "it's", "é", "9 9"]) for _ in range(4000))
    whole = own.aligned([own.encoded(" " + text)])[0]
    before, alignment.SEGMENT = alignment.SEGMENT, 500
    try:
        parts = own.segmented(" " + text)
    finally:
        alignment.SEGMENT = before
    assert whole[:5] == parts[:5] and (whole[5] == parts[5]).all() and (whole[6] == parts[6]).all()
    before, alignment.SEGMENT = alignment.SEGMENT, 50
    try:
        assert own.segmented(" one two " * 40 + "▁") is None
    finally:
        alignment.SEGMENT = before


def test_alignment_of_nothing_and_groups(spark):
    assert alignment.alignment(docs(spark, [])).count() == 0
    assert alignment.alignment(docs(spark, [(1, None), (2, "")])).select("n_a", "n_links", "count_sum", "groups_sha256").distinct().collect() == [(0, 0, 0, "")]
    found = {r.doc_id: r.groups for r in alignment.token_groups(docs(spark, [(1, "a b"), (2, None)])).collect()}
    assert found[2] == "" and len(found[1].split(";")) == 2 and all("|" in g for g in found[1].split(";"))


# SimHash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), seed=42) for k in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    """The least index of the component of each fingerprint."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(1)
        if (least == label).all():
            return label
        label = least


def linked_plainly(listed):
    fps = np.array([fingerprint(t) for _, t in listed], np.uint64)
    label, ids = components(fps), {}
    for (i, _), c in zip(listed, label):
        if i is not None:
            ids[c] = min(i, ids.get(c, i))
    return Counter((i, f"{f:016x}", ids.get(c)) for (i, _), f, c in zip(listed, fps.tolist(), label))


def test_simhash_agrees_with_all_pairs(spark, sf_dir):
    listed = TEXTS + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert Counter(tuple(r) for r in simhash.near_copies(docs(spark, listed), block=16).collect()) == linked_plainly(listed)


def test_simhash_pieces_and_nothing(spark):
    before, simhash.PIECE = simhash.PIECE, 7
    try:
        assert simhash.fingerprint("One two three four five six seven eight nine ten eleven twelve") == fingerprint("one two three four five six seven eight nine ten eleven twelve")
    finally:
        simhash.PIECE = before
    assert simhash.near_copies(docs(spark, [])).count() == 0
    got = simhash.near_copies(docs(spark, [(None, "a"), (None, "a"), (3, None), (2, " ")])).collect()
    assert Counter(r.component_id for r in got) == {None: 2, 2: 2}


def test_gray_rank(spark):
    got = spark.range(64).withColumn("rank", simhash.gray_rank(simhash.F.col("id"))).orderBy("rank").collect()
    assert all((a.id ^ b.id).bit_count() == 1 for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("n, block, seed", [(1, 64, 1), (17, 64, 2), (900, 64, 3), (900, 4096, 4), (500, 8, 5)])
def test_index_finds_every_link(spark, n, block, seed):
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 2**63, 30, dtype=np.uint64)[rng.integers(0, 30, n)]
    for _ in range(4):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) * (rng.random(n) < 0.6).astype(np.uint64)
    fps = np.unique(fps)
    lowest = simhash.blocks(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long"), block)
    assert sorted(x for r in lowest.collect() for x in r.fps) == sorted(fps.view(np.int64).tolist()) and max(len(r.fps) for r in lowest.collect()) <= block
    found = simhash.edges(lowest, simhash.node_pairs(lowest)).collect()
    at = {int(x): k for k, x in enumerate(fps.view(np.int64))}
    root = simhash.least_roots(np.arange(len(fps)), np.array([at[r.a] for r in found], int), np.array([at[r.b] for r in found], int))
    assert (root == components(fps)).all()


# Merkle manifest


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """(root, siblings of each leaf as (place, others) by level)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([hashed(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    proofs = []
    for i in range(len(leaves)):
        own = []
        for level in levels[:-1]:
            run = level[i - i % 3 : i - i % 3 + 3]
            own.append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
            i //= 3
        proofs.append(own)
    return levels[-1][0], proofs


def manifest_plainly(listed):
    by_source = {}
    for r in listed:
        by_source.setdefault(r[1], []).append((r[0], hashed(*map(value, r))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by_source[s]])
    root, tops = tree([trees[s][0] for s in order])
    return Counter((i, leaf, trees[s][0], root, tuple(f"{at}{''.join(others)}" for at, others in proof + tops[k])) for k, s in enumerate(order) for (i, leaf), proof in zip(by_source[s], trees[s][1]))


def numbered_rows(spark, n, sources, seed=0):
    rng = random.Random(seed)
    found = [(rng.choice([None, *range(n)]) if rng.random() < 0.05 else k, rng.choices([None, "", "b", "é", *map(str, range(sources))], [1, 1, 1, 1, *([9] * sources)])[0], "en", k, rng.choice([None, "", "a\nb", "é" * 5])) for k in range(n)]
    found += found[:3]
    return found, spark.createDataFrame([(*r, "extra", 1) for r in found], "doc_id long, source string, lang string, n_chars long, text string, leaf2 string, `meta.x` int")


@pytest.mark.parametrize("n, sources", [(1, 1), (7, 3), (90, 1), (300, 2), (120, 60)])
def test_manifest_agrees_with_plain_trees(spark, n, sources):
    listed, df = numbered_rows(spark, n, sources, n)
    rows_ = df.select("doc_id", "source", merkle.leaf().alias("leaf"), "`meta.x`")
    got = merkle.manifest(rows_)
    assert got.columns == ["doc_id", "source", "leaf", "meta.x", "subroot", "root", "proof"]
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(r.proof)) for r in got.collect()) == manifest_plainly(listed)
    assert got.where(merkle.folded(merkle.F.col("leaf"), merkle.F.col("proof")) != merkle.F.col("root")).count() == 0
    assert got.where(merkle.folded(merkle.F.sha2("leaf", 256), merkle.F.col("proof")) == merkle.F.col("root")).count() == 0


def test_manifest_of_nothing(spark):
    _, df = numbered_rows(spark, 1, 1)
    assert merkle.manifest(df.limit(0).select("doc_id", "source", merkle.leaf().alias("leaf"))).count() == 0


def test_blocks_that_miss_messages_are_told():
    with pytest.raises(ValueError, match="misses"):
        merkle.completed(((0, 0), [(0, "a", False), (2, "b", True)]))
    with pytest.raises(ValueError, match="misses"):
        merkle.completed(((0, 0), [(0, "a", False)]))


def test_manifest_agrees_with_sql(spark, sf_dir):
    found = merkle.op13_merkle_manifest(spark, sf_dir).toPandas()
    assert rows(found) == rows(duck(sf_dir).execute(merkle.ORACLE["op13_merkle_manifest"]).fetchdf())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in found.itertuples():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 2 == 1 or "\n" not in (texts[r.doc_id] or ""))

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from compare import duck, rows
from fixtures import LONG, TEXTS, docs
from tokenizers import Tokenizer

from sparkloom.llm import bpe_codec, fingerprints, language_id, license_scan, pii, token_files, url_filter

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=3000, seed=3):
    r = random.Random(seed)
    letters = list("abcdefgh  \n\t\x1c\x85\xa0'’ÀÉßΣσςİıﬁ日本🎉0123４Ⅷ.,!?_-´²½µªÿ÷") + ["'s", "'re", "<|endoftext|>", "<|startoftext|>", "<|", "é", "K", "aaaa", "  ", "hello", "THE", "Ll"]
    made = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return [*made, "", "a" * 700, "ab" * 300, "hello" * 200, "!" * 300, "🎉" * 50, *(t or "" for _, t in TEXTS)]


def test_word_automaton_agrees_with_the_library():
    library, own = Tokenizer.from_file(WORD), bpe_codec.Codec(WORD)
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_one_transition_a_letter(monkeypatch):
    """Each letter of a word is one look-up; words met before need no new transition, and a full table is begun anew."""
    class Counted(dict):
        asked = 0

        def get(self, *k):
            Counted.asked += 1
            return super().get(*k)

    library, own = Tokenizer.from_file(WORD), bpe_codec.Codec(WORD).automaton
    own.table = Counted(own.table)
    made = []
    step = own.step
    monkeypatch.setattr(own, "step", lambda *k: made.append(k) or step(*k))
    words = ["tokenization", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "unbelievable", "x", "ababababab"]
    for word in words * 2:
        Counted.asked = 0
        assert own.path(word) == library.encode(word, add_special_tokens=False).ids
        assert Counted.asked == len(word)
    assert len(made) == len(set(made)) <= sum(map(len, words))
    #: Of the tokens that a letter completes, exactly one has its arc.
    for subset in list(own.subsets):
        for letter in map(ord, "aeinst"):
            nodes = [(x >> 32, own.children.get((x & bpe_codec.NODE) << bpe_codec.KEY | letter)) for x in subset]
            done = [t for u, x in nodes if x is not None and (t := own.token_at[x]) >= 0 and (not u or own.arc(u - 1, t))]
            assert len(done) == 1
    monkeypatch.setattr(bpe_codec, "SUBSETS", 5)
    small = bpe_codec.Codec(WORD)
    for text in odd_texts(200, 9):
        assert small.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(small.automaton.subsets) <= 5 + 2


def test_other_vocabularies_are_refused():
    for make, path in ((bpe_codec.Codec, BYTE), (token_files.Encoder, WORD)):
        with pytest.raises(ValueError):
            make(path)


def test_numbers_by_range(tmp_path):
    import numpy as np
    import pyarrow.fs as pafs

    np.arange(50, dtype="<i8").tofile(tmp_path / "x")
    far = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    for fs, path in ((pafs.LocalFileSystem(), str(tmp_path / "x")), (far, "x")):
        assert token_files.Numbers(fs, path, "<i8")[7:12].tolist() == [7, 8, 9, 10, 11]


def test_byte_encoder_agrees_with_the_library():
    import numpy as np

    library, own = Tokenizer.from_file(BYTE), token_files.Encoder(BYTE)
    for text in odd_texts(seed=4):
        assert np.frombuffer(own.encoded(text), own.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_codec_query_columns(spark):
    library = Tokenizer.from_file(WORD)
    want = Counter()
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe_codec.encode_documents(docs(spark), WORD).collect()) == want
    assert bpe_codec.encode_documents(docs(spark, []), WORD).count() == 0
    got = {r.doc_id: r.ids for r in bpe_codec.token_ids(docs(spark, [(1, "Hello, hello")]), WORD).collect()}
    assert got == {1: library.encode("Hello, hello", add_special_tokens=False).ids}


@pytest.mark.parametrize("group", [token_files.GROUP, 2])
def test_token_files_round_trip(spark, tmp_path, monkeypatch, group):
    import zlib

    import numpy as np

    library = Tokenizer.from_file(BYTE)
    null_ids = [(None, f"text {k}") for k in range(200)] + [(3, "same id")] * 100
    for name, rows_, piece in (("some", TEXTS, token_files.PIECE), ("none", [], 100), ("one", [(5, "a")], 1), ("small", TEXTS, 64), ("nulls", null_ids, 300)):
        folder = f"file://{tmp_path}/{name}"
        if rows_:
            (tmp_path / name).mkdir()
            (tmp_path / name / "part-000000-0000-lost.bin").write_bytes(b"x")
        monkeypatch.setitem(token_files.one_piece.__globals__, "GROUP", group)
        manifest = token_files.write(docs(spark, rows_), BYTE, folder, partitions=3, piece=piece)
        assert not rows_ or {p.stem for p in (tmp_path / name).iterdir()} == {r.name for r in manifest.collect()}
        if name == "nulls":
            assert manifest.count() >= 3 and {r.part for r in manifest.collect()} == {0, 1, 2}
        got = token_files.read(manifest, folder).collect()
        ordered = sorted((x for x in rows_), key=lambda x: (x[0] is not None, x[0] or 0))
        assert sorted(((r.doc_id is not None, r.doc_id or 0) for r in got)) == sorted((i is not None, i or 0) for i, _ in ordered)
        start = 0
        want = Counter()
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == start
            start += r.n_tokens
        for i, t in rows_:
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
            want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
        assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in ordered]


def test_token_files_query(spark, sf_dir):
    got = token_files.op7_token_files(spark, sf_dir).orderBy("doc_id").collect()
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens


# Licences


def licence_base(t):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(table))
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENCES = [
    (1, "Cc  BY. x CC-by all rights. RESERVED é"),
    (2, "Released under the MIT License."),
    (3, "the mit license"),
    (4, "license license license mit"),
    (5, "x " * 50 + "This work is licensed under the GNU General Public License, version 3. " * 3),
    (6, "Licensed under the Apache License, Version 2.0. Released under the MIT License."),
    (7, "general public\nlicense"),
]


def test_licences(spark):
    every = [*TEXTS, *((i + 100, t) for i, t in LICENCES)]
    got = license_scan.scan(docs(spark, every)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((i, *licence_base(t)) for i, t in every)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[101] == "cc-by,reserved" and labels[102] == labels[103] == "mit" and labels[104] == "" and labels[105] == "gpl,gpl-3.0"
    assert labels[106] == "apache-2.0,mit" and labels[107] == "gpl" and labels[1] == ""
    assert all(0 <= r.score <= 1 for r in got)
    assert license_scan.scan(docs(spark, [])).count() == 0


def licence_labels(t):
    """Labels and score of every place where a key phrase stands."""
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())
    labels, score = set(), 0.0
    for phrase, label in license_scan.BASE:
        if any(w[i : i + len(phrase.split())] == phrase.split() for i in range(len(w))):
            labels.add(label)
            score = 1.0
    for label, line, key in license_scan.TEMPLATES:
        line, key = line.split(), key.split()
        shift = next(i for i in range(len(line)) if line[i : i + len(key)] == key)
        for i in range(len(w)):
            if w[i : i + len(key)] == key:
                labels.add(label)
                start = i - shift
                score = max(score, sum(0 <= start + j < len(w) and w[start + j] == x for j, x in enumerate(line)) / len(line))
    return ",".join(sorted(labels)), score


def test_several_licences_in_long_prose(spark):
    r = random.Random(7)
    lines = [x for _, *both in license_scan.TEMPLATES for x in both]
    bsd = next(line for label, line, _ in license_scan.TEMPLATES if label == "bsd")
    prose = "charge copy domain fee forms free " + "lorem ipsum " * 200
    texts = [f"{bsd}. {lines[0]}", f"{bsd}; Released under the MIT License", *(f"{prose} {x} {prose}" for x in lines)]
    words = sorted({w for x in lines for w in x.split()})
    for _ in range(150):
        parts = [r.choice(lines) if r.random() < 0.3 else " ".join(r.choices([*words, "x"], k=r.randint(1, 20))) for _ in range(r.randint(1, 8))]
        texts.append(" ".join(parts))
    got = {x.doc_id: (x.labels, x.score) for x in license_scan.scan(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        labels, score = licence_labels(t)
        assert got[i][0] == labels and got[i][1] == pytest.approx(score), t


def test_every_line_in_one_text_and_many_templates(spark):
    """No licence crowds out another; the plan does not grow with the templates."""
    every = " and so on ".join(line for _, line, _ in license_scan.TEMPLATES)
    got = license_scan.scan(docs(spark, [(1, every), (2, every + " " + every)])).collect()
    assert {r.labels for r in got} == {licence_labels(every)[0]} and set(license_scan.TEMPLATES[0]) and len({label for label, _, _ in license_scan.TEMPLATES} - set(got[0].labels.split(","))) == 0
    many = tuple((f"own-{k}", f"this text is under the terms of license number{k} of maker{k % 7}", f"license number{k} of maker{k % 7}") for k in range(300))
    got = {r.doc_id: r.labels for r in license_scan.scan(docs(spark, [(k, f"see license number{k} of maker{k % 7} here") for k in range(0, 300, 11)]), templates=many).collect()}
    assert got == {k: f"own-{k}" for k in range(0, 300, 11)}


def test_licence_query(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in license_scan.op3_license_scan(spark, sf_dir).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == licence_base(text[r.doc_id])


# Personal data


def base_spans(t):
    t, out = t or "", []
    for x in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", x.start(), x.end()))
    for x in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in x.group().split(".")):
            out.append(("ip", x.start(), x.end()))
    for x in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", x.group())
        if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", x.start(), x.end()))
    for x in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", x.group())) <= 15:
            out.append(("phone", x.start(), x.end()))
    return out


def test_personal_data_base(spark):
    r = random.Random(1)
    letters = list("0123456789") * 3 + list("ab.@-+ (_%é🎉\n") + ["@a.b", "1.2.3.4", "4845168114407329", " 55 "]
    every = [*TEXTS, *((100 + i, "".join(r.choice(letters) for _ in range(r.randint(0, 60)))) for i in range(1500)), (5000, "1.2.3.4 " * 700), (5001, "a@b.c " * 600)]
    got = pii.redacted(docs(spark, every)).collect()
    texts = {}
    for i, t in every:
        texts.setdefault(i, []).append(t)
    digest = lambda spans: hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    assert Counter((x.doc_id, x.base_sha256, x.n_email, x.n_ip, x.n_card, x.n_phone) for x in got) == Counter((i, digest(s := base_spans(t)), *(sum(k == kind for k, _, _ in s) for kind in pii.KINDS)) for i, t in every)
    for x in got:
        if len(texts[x.doc_id]) == 1:
            spans = [tuple(s.split(":")) for s in x.spans.split(",") if s]
            assert {(k, str(a), str(b)) for k, a, b in base_spans(texts[x.doc_id][0])} <= set(spans)


def test_personal_data_long_texts(spark):
    every = [(1, "a." * 100_000 + "@x.y"), (2, "1 " * 100_000), (3, "a@" + "b." * 100_000 + "c"), (4, "9" * 200_000), (5, "+1" * 50_000), (6, "a" * 500_000)]
    got = {r.doc_id: r for r in pii.redacted(docs(spark, every)).collect()}
    assert got[1].n_email == got[3].n_email == 1 and got[4].n_card == 0


def test_personal_data_method(spark):
    found = {r.doc_id: r.spans for r in pii.redacted(docs(spark, [(1, "ssn: 123-45-6789 ok"), (2, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'), (3, "version 2024-01-05 and 12.11.2020"), (4, "plain prose without any of it")])).collect()}
    assert found[1].startswith("number:5:16") and found[2].startswith("key:") and found[3] == "" and found[4] == ""
    assert pii.redacted(docs(spark, [])).count() == 0


def test_boosting_learns():
    prior, trees = pii.boosted([[float(i)] for i in range(40)], [int(i >= 20) for i in range(40)])
    score = lambda x: prior + sum(pii.value(t, [x]) for t in trees)
    assert score(3) < 0 < score(33)


# Languages


def test_suffix_automaton_accepts_substrings_only():
    r = random.Random(2)
    codes = [r.randint(0, 3) for _ in range(200)]
    table = language_id.suffix_automaton(codes, 4)
    whole = "".join(map(str, codes))
    for _ in range(2000):
        word = [r.randint(0, 3) for _ in range(r.randint(1, 7))]
        state = language_id.ROOT
        for c in word:
            state = table[state, c] if state else 0
        assert bool(state) == ("".join(map(str, word)) in whole)


def test_phrases_against_brute_force():
    model = language_id.Model({"a": ["abcabd abx"], "b": ["xyz zyx"]})
    names, _ = model.predict(["abcab", "zyxyz", None, "123", "", "ABC"])
    assert names == ["a", "b", "und", "und", "und", "a"]
    r = random.Random(5)
    text = "".join(r.choice("abcdxyz ") for _ in range(3000))
    reference = "".join(map(chr, [0, *model.coded("abcabd abx")]))
    codes, count, i = "".join(map(chr, model.coded(text))), 0, 0
    while i < len(codes):
        n = 0
        while i + n < len(codes) and codes[i : i + n + 1] in reference:
            n += 1
        i += max(1, n)
        count += 1
    import pickle

    import numpy as np

    coded = model.coded(text)
    sent = pickle.loads(pickle.dumps(model))
    for m in (model, sent):
        assert m.parsed([coded, coded[:0], coded[:5]])[0].tolist()[:2] == [count, 0]


@pytest.mark.parametrize("block, head", [(1024, 192), (7, 3), (16, 1), (64, 64)])
def test_blocks_do_not_show(monkeypatch, block, head):
    """Whatever the blocks, texts have the phrases of a parse from the first letter to the last."""
    import numpy as np

    r = random.Random(block)
    model = language_id.Model({"a": ["abcabd abx bcabca"], "b": ["xyz zyx xxy"], "c": ["".join(r.choice("abcdxyz ") for _ in range(900))]})
    coded = [model.coded("".join(r.choice("abcdxyzq ") for _ in range(n))) for n in (0, 1, 5, 2100, 40, 4000, *range(1, 90))]
    monkeypatch.setattr(language_id, "BLOCK", 1 << 20)
    whole = model.parsed(coded)
    for name, value in (("BLOCK", block), ("HEAD", head), ("LANES", 50)):
        monkeypatch.setattr(language_id, name, value)
    assert np.array_equal(model.parsed(coded), whole)


def test_shares_of_a_budget():
    import numpy as np

    texts = [np.zeros(n) for n in (5, 100, 40)]
    assert [len(x) for x in language_id.shared(texts, 90)] == [5, 45, 40]
    assert [len(x) for x in language_id.shared(texts, 1000)] == [5, 100, 40] and language_id.shared([], 5) == []


def test_languages_of_several_scripts():
    """Held-out texts of alphabets that do not fit into 60 letters together, two of them Han."""
    r = random.Random(11)
    scripts = {"en": (0x61, 26), "ru": (0x430, 32), "el": (0x3B1, 17), "th": (0xE01, 46), "zh": (0x4E00, 1500), "ja": (0x4E00 + 1000, 1500), "ko": (0xAC00, 1000)}
    words = {k: ["".join(chr(at + r.randrange(n)) for _ in range(r.randint(1, 6))) for _ in range(300)] for k, (at, n) in scripts.items()}
    made = lambda k: " ".join(r.choices(words[k], k=40))
    model = language_id.Model({k: [made(k) for _ in range(96 if k == "en" else 30)] for k in scripts})
    texts = [(k, made(k)) for k in scripts for _ in range(30)]
    names, _ = model.predict([t for _, t in texts])
    right = Counter(k for (k, _), name in zip(texts, names) if k == name)
    assert all(right[k] >= 29 for k in scripts), right


def test_language_edges(spark):
    rows_ = [*TEXTS, *((200 + i, "the cat and the dog") for i in range(30))]
    found = language_id.identify(docs(spark, rows_), language_id.fit(docs(spark, rows_))).collect()
    assert len(found) == len(rows_)
    import zlib

    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    assert {r.lang_pred for r in found if r.doc_id in (4, 5, 6)} == {"und"}
    none = language_id.fit(docs(spark, []))
    assert {r.lang_pred for r in language_id.identify(docs(spark), none).collect()} == {"und"}
    kept = language_id.identified(docs(spark, rows_), language_id.fit(docs(spark, rows_)))
    assert kept.columns == docs(spark).columns and kept.where("text IS NULL OR trim(text) = ''").count() == 0


def test_language_accuracy_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs_ = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = language_id.op5_language_id(spark, d).join(docs_, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


# Fingerprints


def likeness(a, b):
    cut = lambda t: {p.strip() for p in fingerprints.PARAGRAPH.findall(t)}
    a, b = cut(a), cut(b)
    return 1.0 if not a | b else len(a & b) / len(a | b)


@pytest.mark.parametrize("ranges", [1, 4])
def test_fingerprints_against_brute_force(spark, ranges):
    rows_ = [(i, t) for i, t in TEXTS if i is not None and i != 8] + [(20 + i, "\n".join(f"line {j % (i + 3)}. more {j}" for j in range(i * 7))) for i in range(20)]
    ordered = sorted(rows_, key=lambda r: -r[0])
    want = {}
    for k, (i, t) in enumerate(ordered):
        t, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        want[i] = len(t), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(t, edited), 9), round(likeness(t, following), 9)
    got = fingerprints.with_next(docs(spark, rows_), ranges=ranges).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got} == want
    same = {}
    for r in got:
        same.setdefault(dict(rows_)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_fingerprint_edges(spark):
    assert fingerprints.with_next(docs(spark, [])).count() == 0
    assert fingerprints.with_next(docs(spark)).count() == len(TEXTS)
    one = fingerprints.with_next(docs(spark, [(3, "a.\nb")])).first()
    assert one.near_next == 1.0 and one.n_chars == 4
    assert fingerprints.fingerprints(docs(spark)).count() == len(TEXTS)


def test_peeling_recovers_and_fails_honestly():
    import numpy as np

    keys = np.random.default_rng(1).integers(1, 2**63, 300).astype(np.uint64)
    s = fingerprints.Sketches(1, 12, np.zeros(300, np.int64), keys)
    assert not s.peel()[1][0]
    s = fingerprints.Sketches(1, 768, np.zeros(300, np.int64), keys)
    found, done = s.peel()
    assert done[0] and found[0] == 300


# URLs

URLS = [None, "no scheme", "http://org/", "HTTP://A.Example.ORG/en/12?x", "https://x.example.org/es", "https://x.example.org/es/1", "http://y.com/fr/a#b", "http://com/de/", "http://notcom/de/", "http://z.com", "http://q.com?u=http://org/", "http://spam-farm.example.org", "http://m.cheap-pills.example.com/x", "://a.org/", "http://example.org/en/1", "http://" + "a." * 3000 + "org/x", "http://example.com/" + "p" * 100_000, "http://user:pw@Casino.Example.NET.:8080", "http://x.example.com:80//ads//1", "http://x.example.org/de//ads/", "http://@:80/x", "http://notcasino.example.com/ads"]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, l_verdict string")


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    own = re.sub(r"\.$", "", re.sub(":[0-9]*$", "", host.split("@")[-1]))
    own_path = re.sub("/+", "/", "/" + path) if own else ""
    fits = lambda rules, host, path: max(((len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    base, more = fits(url_filter.RULES, host, path), fits(url_filter.default_list(), own, own_path)
    return host, path, base and base[1], (base or more or (0, "", "allow"))[2]


def test_urls(spark):
    urls = [*URLS, *URLS]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages(spark, urls), url_filter.listed(spark)).collect()}
    assert got == {i: judged(u) for i, u in enumerate(urls)}
    assert url_filter.judge(pages(spark, []), url_filter.listed(spark)).count() == 0
    long_list = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages(spark, urls), url_filter.listed(spark), broadcast=0).collect()}
    assert long_list == got
    nothing = spark.createDataFrame([], "host string, path string, verdict string")
    none = url_filter.judge(pages(spark, URLS[:3]), url_filter.listed(spark, (), nothing)).collect()
    assert {r.verdict for r in none} == {"allow"}


def test_a_list_from_a_table(spark):
    """Entries in any form, null and repeated ones; frequent and null URLs."""
    own = spark.createDataFrame([("Bad.Example.com:80", None, "block"), ("u@bad.example.com.", "", "block"), ("shop.example.com", "//a", "block"), (None, "/", "block"), ("x.com", "/", None), ("", "/", "block")], "host string, path string, verdict string")
    urls = ["http://bad.example.com"] * 50 + [None] * 50 + ["http://www.shop.example.com/ab", "http://shop.example.com/b", "http://x.com/"]
    got = [(r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages(spark, urls), url_filter.listed(spark, (), own)).collect()]
    assert sorted(got) == [(i, None, "block" if i < 50 or i == 100 else "allow") for i in range(len(urls))]


def test_urls_agree_with_sql(spark, sf_dir):
    found = url_filter.op9_url_filter(spark, sf_dir).toPandas()
    assert rows(found) == rows(duck(sf_dir).execute(url_filter.ORACLE["op9_url_filter"]).fetchdf())

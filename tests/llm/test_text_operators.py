"""Operators on texts against plain versions, with odd rows: nulls, empties, long texts, ties, repeats, clashing columns."""

import random

import numpy as np
import pytest

from shelfstream.llm import packing, phrases, pii, simhash, substring, suffixes
from shelfstream.llm.components import components

from . import brute

SCHEMA = "doc_id long, text string, part int, fp long, component string, length int, n_chars long"
TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def texts_with_repeats(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "ß́", "日本"]
    passage = " ".join(rng.choices(words, k=40))
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 80))) for _ in range(30)]
    texts += [f"{t} {passage} {rng.choice(texts)}" for t in texts[:12]]
    texts += [texts[3], texts[3], "a " * 900, "b" * 3000, "", None, " \t\n", "x\x0by\x0cz", "w1 w2 w3 w4"]
    return texts


def table(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, 9, 9, "x", 9, 9) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd():
    texts = texts_with_repeats(5)
    # A repeated row, two texts of one id, a null id.
    ids = [*range(len(texts) - 3), 3, 3, None]
    return list(zip(ids, texts))


@pytest.fixture(scope="module")
def odd_docs(spark, odd):
    return table(spark, [t for _, t in odd], [i for i, _ in odd])


def sorted_rows(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("part_bytes", [300, 1 << 20])
def test_substring_dedup(odd, odd_docs, part_bytes):
    got = substring.dedup_substrings(odd_docs, width=6, part_bytes=part_bytes).collect()
    assert sorted_rows((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted_rows(brute.substring_dedup(odd, 6))
    assert any(r.n_removed for r in got)
    assert all(sum(s.stop - s.start for s in r.removed) == r.n_removed for r in got)


@pytest.mark.parametrize(("part_bytes", "crowd"), [(400, 2000), (400, 2), (1 << 20, 2000)])
def test_suffix_dedup(odd, odd_docs, part_bytes, crowd):
    got = suffixes.dedup_bytes(odd_docs, length=30, anchor=10, part_bytes=part_bytes, crowd=crowd).collect()
    assert sorted_rows((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in got) == sorted_rows(brute.byte_dedup(odd, 30))


def test_repeated_strings_by_interval_expansion():
    rng = random.Random(3)
    for trial in range(40):
        length = rng.choice([3, 5, 20])
        contents = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 60))) for _ in range(8)]
        weights = [rng.choice([1, 1, 2]) for _ in contents]
        counts = {}
        for c, w in zip(contents, weights):
            for i in range(len(c) - length + 1):
                counts[c[i : i + length]] = counts.get(c[i : i + length], 0) + w
        want = [[counts[c[i : i + length]] > 1 for i in range(len(c) - length + 1)] for c in contents]
        assert [h.tolist() for h in suffixes.repeated_strings(contents, weights, length)] == want


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash_components(odd, odd_docs, crowd):
    got = simhash.near_duplicates(odd_docs, crowd).collect()
    want = [(i, brute.simhash(t), c) for (i, t), c in zip(odd, brute.component_ids(odd))]
    assert sorted_rows((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == sorted_rows(want)


@pytest.mark.parametrize("crowd", [64, 3])
def test_links_join_what_all_pairs_would(spark, crowd):
    rng = random.Random(8)
    marks = [0]
    while len(marks) < 300:
        base = rng.choice(marks) if rng.random() < 0.9 else rng.getrandbits(64)
        marks.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    marks = list(set(marks))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    links = simhash.near_links(spark.createDataFrame([(m,) for m in signed], "fp long"), crowd).collect()
    place = {m: i for i, m in enumerate(signed)}
    names = list(range(len(marks)))

    def root(i):
        while names[i] != i:
            i = names[i]
        return i

    for a, b in links:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 2
        names[root(place[a])] = root(place[b])
    want = brute.linked(marks)
    groups = lambda g: {frozenset(i for i in range(len(g)) if g[i] == x) for x in g}
    assert groups([root(i) for i in range(len(marks))]) == groups(want)


def test_golay_words_within_two_bits_share_an_index():
    rng = random.Random(1)
    corrections = simhash._corrections()
    words = np.array([rng.getrandbits(23) for _ in range(300)])
    flips = np.array([(1 << a) ^ (1 << b) for a, b in (rng.sample(range(23), 2) for _ in words)])
    near = simhash.codeword_indices(words ^ flips, corrections)
    for a, b in zip(simhash.codeword_indices(words, corrections), near):
        assert set(a) & set(b) and len(set(a)) <= 6


def test_one_of_each_keeps_first_rows(spark, odd_docs):
    got = [(r.doc_id, r.text) for r in simhash.one_of_each(odd_docs).collect()]
    assert len(got) == len({(r.component) for r in simhash.near_duplicates(odd_docs).collect()})
    assert simhash.one_of_each(odd_docs).columns == odd_docs.columns


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(201, 200), (201, 202), (202, 200), (5, 5), (None, 3)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)}
    assert got == want


def test_fingerprints_of_edits(spark, odd, odd_docs):
    import hashlib

    got = phrases.fingerprint_edits(odd_docs, part_bytes=300).collect()
    assert len(got) == len(odd)
    ordered = sorted(((i, t or "") for i, t in odd if i is not None and i != 3), key=lambda r: r[0])
    by_id = {r.doc_id: r for r in got if r.doc_id != 3}
    for (i, text), (_, following) in zip(ordered, ordered[1:]):
        if i == 2:
            continue  # what follows is one of the rows of id 3
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert by_id[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and by_id[i].n_chars == len(text)
        marks = phrases.fingerprints([text.encode(), edited.encode(), following.encode()])
        assert (by_id[i].fingerprint, by_id[i].edited_fingerprint) == (marks[0].tobytes().hex(), marks[1].tobytes().hex())
        assert by_id[i].near_edited == pytest.approx(phrases.likeness(marks[:1], marks[1:2])[0])
        assert by_id[i].near_next == pytest.approx(phrases.likeness(marks[:1], marks[2:])[0])


def test_equal_substrings_share_names_at_any_offset():
    rng = random.Random(4)
    shared = "".join(rng.choices("abcdefgh ", k=3000)).encode()
    texts = [rng.randbytes(rng.randint(1, 300)) + shared + rng.randbytes(100) for _ in range(20)]
    marks = phrases.fingerprints([shared] * 20)
    assert (phrases.likeness(marks, phrases.fingerprints(texts)) > 0.6).all()
    alone = np.concatenate([phrases.fingerprints([t]) for t in texts])
    assert (alone == phrases.fingerprints(texts)).all()


def test_base_private_spans(spark):
    said = [
        "a@b.co_x@y.zz and a.b@c-d.e.f. x@@y.z @q.w",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.0004 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1112 5500000000000004 1 2 3",
        "+1 (988) 555-2485) +12 +1.2.3.4.5.6.7.8.9 ++1234567890",
        "é日 x@y.de 10.0.0.1\n+4412345678901 4111111111111111",
        "1 " * 3000 + "2@3.4",
        "password=135299847ac0e0f0dc token: \"0641917ea4e9feb9cda83477b57ac265\"",
        "",
        None,
    ]
    docs = table(spark, said)
    for r in pii.find(docs, pii.Trees()).select("row.doc_id", pii.listed("base").alias("base")).collect():
        assert r.base == ",".join(brute.private(said[r.doc_id])), said[r.doc_id][:60]


def test_trained_trees_add_secrets_and_keep_base(spark):
    rng = random.Random(2)
    said = []
    for i in range(120):
        secret = f'{rng.choice(["token", "password"])} = "{rng.randbytes(16).hex()}"'
        plain = f"file-{rng.randint(10, 99)}-of-{rng.randint(1000, 9999)}-parts 20{rng.randint(10, 24)}-01-{rng.randint(10, 28)} 12345678"
        said.append(f"word {secret if i % 2 else plain} mail me.{i}@mail.example.org or +1 (988) 555-{1000 + i} é")
    docs = table(spark, said)
    trees = pii.train(docs)
    assert trees.trees
    n_added = 0
    for r in pii.find(docs, trees).select("row.doc_id", pii.listed("spans").alias("spans")).collect():
        base, all_spans = brute.private(said[r.doc_id]), r.spans.split(",")
        assert set(base) <= set(all_spans)
        added = set(all_spans) - set(base)
        n_added += any(a.startswith("secret") for a in added)
        assert r.doc_id % 2 or not added
    assert n_added == 60
    clean = {r.doc_id: r.text for r in pii.redact(docs, trees).collect()}
    assert clean[1].count("[SECRET]") == 1 and "[EMAIL] or [PHONE] é" in clean[1] and "@" not in "".join(clean.values())
    assert pii.redact(docs, trees).columns == docs.columns


def test_packing_is_gapless_and_whole(spark, odd, odd_docs):
    from tokenizers import Tokenizer

    got = packing.pack(packing.tokenized_pieces(odd_docs, TOKENIZER, sequence_length=64), 64, group_pieces=40).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    sizes = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd)
    assert sorted(n for n in sizes) == sorted(sum(r.length for r in rows) for rows in _by_doc(got, odd))
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(held) <= sum(sizes) / 64 + 4


def _by_doc(got, odd):
    """Pieces grouped into documents: a piece 0 opens one; rows of repeated ids are told apart by their number of pieces."""
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for rows in by_id.values():
        n = sum(r.piece == 0 for r in rows)
        if n == 1:
            yield rows
        else:
            # Each document's pieces continue where its last ended.
            rows = sorted(rows, key=lambda r: (r.piece, -r.length))
            docs = [[r] for r in rows if r.piece == 0]
            for r in rows[n:]:
                next(d for d in docs if len(d) == r.piece).append(r)
            yield from docs


@pytest.mark.parametrize("folds", [True, False])
def test_word_ids_equal_the_tokenizer(folds):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    said = [t or "" for t in texts_with_repeats(9)] + [
        "It's DON'T we'll. end, a.b,c ... x., É. Élań, <|endoftext|>x <|ENDOFTEXT|> y<|startoftext|>.",
        "tab\tnew\nline\x0b\x0c\r  nb em \x1c\x85 ., , . 1234 ½ İstanbul ΣΑΣ",
    ]
    ids = packing.WordIds(TOKENIZER, "<|endoftext|>", folds, memory_bytes=2000)
    for _ in range(2):
        for text in said:
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids([text])[0], "<u4").tolist() == want, text


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(6)
    lengths = sorted((rng.randint(1, 50) for _ in range(400)), reverse=True)
    bins, offsets = packing.best_fit_decreasing(lengths, 50)
    left = {}
    for length, number, offset in zip(lengths, bins, offsets):
        room = left.get(number, 50)
        tightest = min((r for r in left.values() if r >= length), default=50)
        assert room == tightest and offset == 50 - room
        left[number] = room - length


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for frame in (
        substring.dedup_substrings(none),
        suffixes.dedup_bytes(none),
        simhash.near_duplicates(none),
        simhash.one_of_each(none),
        phrases.fingerprint_edits(none),
        pii.find(none, pii.train(none)),
        packing.pack(packing.tokenized_pieces(none, TOKENIZER)),
    ):
        assert frame.count() == 0


def test_trained_trees_add_wider_forms_and_extensions(spark):
    """Spelled-out addresses, phones without a plus and bare keys; no token is assigned to a name in the second half."""
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    said = []
    for i in range(300):
        phone = f"{rng.randint(1, 9)} ({digits(3)}) {digits(3)}-{digits(4)}"
        key = f'token = "{rng.randbytes(16).hex()}"' if i < 150 else "none"
        host = rng.choice(["mail.org", "b.net", "mail.example.org", "news.site.co.uk"])
        said.append(f"so {rng.choice(['jo', 'ann.lee', 'x'])}{i if i % 2 else ''}@{host} or +{phone} with {key} in file-{digits(2)}-of-{digits(4)}-parts and {digits(8)} then 20{digits(2)}-01-{digits(2)}")
    wide = "so jane (at) mail (dot) org then"
    said += [wide, "so 1 (988) 555-2485 then", f"so {rng.randbytes(16).hex()} then", "so jane@mail.example (dot) org then", "so 20240117 then file-12-of-1234-parts"]
    docs = table(spark, said)
    for first in (0, 150):
        part = docs.where(f"doc_id >= {first}")
        trees = pii.train(part)
        got = {r.doc_id: r.spans for r in pii.find(part, trees).where("row.doc_id >= 300").select("row.doc_id", pii.listed("spans").alias("spans")).collect()}
        assert got[300] == "email:3:27" and got[301] == "phone:3:19"
        assert got[302] == ("secret:3:35" if first == 0 else "")
        assert got[303] == "email:3:20,email:3:30" and got[304] == ""
        clean = {r.doc_id: r.text for r in pii.redact(part, trees).where("doc_id >= 300").collect()}
        assert clean[300] == "so [EMAIL] then" and clean[303] == "so [EMAIL] then"


def test_fingerprints_by_plain_parsing(spark):
    rng = random.Random(15)
    said = ["", "a", "aaaa", "ab" * 400, "é日本" * 30, "x" * 5000, " ".join(rng.choices(["one", "two", "three", "\n"], k=700))]
    said += ["".join(rng.choices("abc ", k=rng.randint(1, 900))) for _ in range(25)] + [None]
    docs = table(spark, said)
    got = {r.doc_id: r for r in phrases.fingerprint_edits(docs, part_bytes=500).collect()}
    for i, text in enumerate(said):
        following = said[(i + 1) % len(said)] or ""
        text = text or ""
        edited = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (brute.fingerprint(text), brute.fingerprint(edited)), text[:40]

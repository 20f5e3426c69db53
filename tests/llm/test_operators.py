"""The operators on small odd tables: nulls, empties, ties, repeats, clashing names, no rows."""

from __future__ import annotations

import functools
import hashlib
import operator
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("tideline.llm")

from conftest import plan_of
from pyspark.sql import functions as F

from tideline.llm import cross_entropy, exact_dedup, imatch, language, minhash, mixing, packing, pii
from tideline.llm import superkmers, toxicity
from tideline.llm.common import RELEASE, stage
from tideline.llm.components import connected_components, joined_components
from tideline.llm.queries import packing_vocabulary

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score double, size long, row string, key string, kept boolean, lang_pred string"
)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdefghiklmnorstu", k=rng.randint(2, 7))) for _ in range(400)]
    prose = [" ".join(rng.choices(names, k=rng.randint(30, 90))) for _ in range(24)]
    passage = " ".join(rng.choices(names, k=45))
    rows: list[tuple[int | None, str | None]] = list(enumerate(prose))
    rows += [(100 + k, prose[k] + " tail") for k in range(4)]
    rows += [(200, prose[0]), (201, prose[0].upper()), (202, prose[5]), (202, prose[5])]
    rows += [(300 + k, f"{prose[10 + k]} {passage} {prose[12 + k]}") for k in range(3)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one two"), (404, "one two"), (None, prose[1]), (None, None)]
    rows += [(500, " ".join(rng.choices(names, k=6000))), (501, "x" * 30_000), (502, "ab ab " * 200)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    langs, sources = ["en", "de", None], ["a", "b", None]
    rows = [
        (i, t, langs[k % 3], sources[k % 3], None, None, None, None, None, None, None)
        for k, (i, t) in enumerate(texts())
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("false")


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}}


def test_exact_dedup_counts_every_row(docs, nothing):
    rows = exact_dedup.copy_groups(docs).collect()
    assert len(rows) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in rows if r.text_sha256 == empty} == {
        (400, 401, 3), (401, 401, 3), (None, 401, 3)
    }
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({t or "" for _, t in texts()})
    assert exact_dedup.copy_groups(nothing).count() == exact_dedup.deduplicate(nothing).count() == 0


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = WORDS.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_equal_brute_force(docs, nothing):
    rows = [(i, shingles(t)) for i, t in texts()]
    least = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for i, a in rows:
            for j, b in rows:
                if i is None or j is None or not a or not b or least[i] <= least[j]:
                    continue
                if 100 * len(a & b) >= 75 * len(a | b):
                    least[i], changed = least[j], True
    found = minhash.near_duplicates(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in found))) == sorted(
        map(repr, ((i, len(s), least.get(i)) for i, s in rows))
    )
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert minhash.near_duplicates(nothing).count() == 0


def members_of_one_key(spark, wides, sizes=None):
    """Members of one key, and their signatures."""
    rows = [(k, wide, sizes[k] if sizes else 100) for k, wide in enumerate(wides)]
    signatures = spark.createDataFrame(rows, "id long, wide binary, n_shingles long")
    n = F.lit(len(rows)).cast("long").alias("n")
    return signatures.select(F.lit(7).cast("long").alias("key"), "id", n), signatures


@pytest.mark.parametrize("block", [2, 3, 100])
def test_every_pair_across_components_is_compared(spark, block):
    n = 14
    wides = [bytes(minhash.WIDE)] * n + [bytes([1]) * minhash.WIDE]
    members, signatures = members_of_one_key(spark, wides, [100] * (n - 1) + [74, 100])
    components = spark.createDataFrame([(4, 1), (1, 1), (9, 1)], "id long, component long")
    found = minhash._across(members, signatures, components, block).collect()
    # The last one is far from all, the one before it too small for any.
    expected = [(i, j) for i in range(n - 1) for j in range(i + 1, n - 1) if not {i, j} <= {1, 4, 9}]
    assert sorted(map(tuple, found)) == expected


@pytest.mark.parametrize("block, held", [(1000, 1 << 20), (1000, 50), (40, 1 << 20)])
def test_a_forest_joins_what_is_near_by_few_pairs(spark, monkeypatch, block, held):
    monkeypatch.setattr(minhash, "HELD", held)
    rng = random.Random(4)
    kinds = [bytes(rng.choices(range(256), k=minhash.WIDE)) for _ in range(5)]
    wides = [bytes([rng.randrange(256)] * 20) + kinds[k % 5][20:] for k in range(200)]
    members, signatures = members_of_one_key(spark, wides)
    none = spark.createDataFrame([], "id long, component long")
    forest = minhash._across(members, signatures, none, block, 0).collect()
    assert len(forest) <= 195 and all((a - b) % 5 == 0 for a, b in forest)
    if block > 200:
        found = connected_components(spark.createDataFrame(forest, "a long, b long"))
        assert {(r.id, r.component) for r in found.collect()} == {(k, k % 5) for k in range(200)}


def test_a_hot_key_of_similar_texts_emits_less_than_its_members(spark):
    """20,000 members of one key, near each other in groups: a third of them in one."""
    rng = np.random.default_rng(1)
    kinds = rng.integers(0, 256, (400, minhash.WIDE), dtype=np.uint8)
    of = np.where(np.arange(20_000) % 3 == 0, 0, np.arange(20_000) % 400)
    components = spark.createDataFrame(
        [(k, int(of[k])) for k in range(20_000) if of[k] == 0 and k], "id long, component long"
    )
    members, signatures = members_of_one_key(spark, [kinds[k].tobytes() for k in of])
    found = minhash._across(members, signatures, components, 4096, 0).distinct()
    assert 0 < found.count() < 20_000
    components = joined_components(components, found)
    again = minhash._across(members, signatures, components, 4096, 1).distinct()
    assert again.count() < 8000
    components = joined_components(components, again)
    # What is left apart after two ways to cut the key is little.
    assert minhash._across(members, signatures, components, 4096).count() < 2000


@pytest.mark.parametrize("block, sets", [(4096, 1 << 20), (7, 900)])
def test_near_pairs_that_are_not_linked_leave_no_task(spark, monkeypatch, block, sets):
    """Texts that share a passage, pair by pair a little below the similarity, and three that link."""
    rng = random.Random(9)

    def words(k: int) -> list[str]:
        return [f"w{rng.randrange(10**9)}" for _ in range(k)]

    passage = words(120)
    rows = [(k, " ".join(passage + words(25))) for k in range(150)]
    rows += [(1000, rows[3][1] + " " + rows[3][1][-20:]), (1001, rows[77][1] + " more of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = []
    across, links = minhash._across, minhash._linked_across

    def counted(*args):
        found = links(*args[:4], block, sets)
        made.append(found.count())
        return found

    def no_pairs(members, signatures, components, block, forest):
        assert forest is not None
        return across(members, signatures, components, block, forest)

    monkeypatch.setattr(minhash, "FORESTS", ())
    monkeypatch.setattr(minhash, "_across", no_pairs)
    monkeypatch.setattr(minhash, "_linked_across", counted)
    # Nothing is linked before the search across components.
    monkeypatch.setattr(minhash, "connected_components", lambda edges: connected_components(edges.limit(0)))
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    sets_of = {
        k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in rows)
    }
    alike = [
        (a, b) for a in sets_of for b in sets_of
        if a < b and 100 * len(sets_of[a] & sets_of[b]) >= 75 * len(sets_of[a] | sets_of[b])
    ]
    expected = {k: k for k in sets_of}
    for a, b in alike:
        low, high = sorted((expected[a], expected[b]))
        expected = {k: low if c == high else c for k, c in expected.items()}
    assert found == expected and 0 < made[0] <= 4 * len(alike) + len(rows)


def test_rows_of_one_id_and_different_texts(spark):
    """Id 5 names a near copy of 3 and a text of its own; only the copy goes."""
    rng = random.Random(12)
    names = [f"n{k}" for k in range(500)]
    one, other = (" ".join(rng.choices(names, k=60)) for _ in range(2))
    rows = [(3, one), (5, one + " tail"), (5, other), (6, None), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = minhash.deduplicate(docs).collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, [rows[0], *rows[2:]]))


def test_near_duplicates_do_not_depend_on_the_block(docs):
    assert sorted(map(repr, minhash.near_duplicates(docs, block=2).collect())) == sorted(
        map(repr, minhash.near_duplicates(docs).collect())
    )


@pytest.mark.parametrize("sent, held, bucket", [(10**6, 10**8, 10**4), (0, 500, 3), (10**6, 2000, 1)])
def test_repeated_windows_equal_brute_force(docs, nothing, monkeypatch, sent, held, bucket):
    for name, value in (("SENT", sent), ("HELD", held), ("BUCKET", bucket)):
        monkeypatch.setattr(superkmers, name, value)
    seen: set[tuple[str, ...]] = set()
    expected: list[tuple] = []
    own = {}
    for i, text in sorted(set(texts()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        own[i, text] = (i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    expected = [own[row] for row in texts()]
    found = superkmers.without_repeats(docs).drop("kept_text").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert superkmers.without_repeats(nothing).count() == 0


def test_mix_stays_near_its_targets(docs, nothing):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.copies <= 3 for r in rows)
    for source in {r.row.source for r in rows}:
        own = [r for r in rows if r.row.source == source]
        taken = sum(r.copies * r["size"] for r in own)
        # What is left is less than the longest document, which may not fit.
        assert 0 <= own[0].target - taken <= max(r["size"] for r in own)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs.repartition(2)).collect()))
    assert mixing.mixed(nothing).count() == 0


def test_packing_holds_every_id_once(docs, nothing):
    from tokenizers import Tokenizer

    pieces = packing.pack(docs, packing_vocabulary()).collect()
    tokenizer = Tokenizer.from_file(packing_vocabulary())
    expected = sum(
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts()
    )
    assert sum(p.length for p in pieces) == expected
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack(nothing, packing_vocabulary()).count() == 0


def test_words_of_texts_are_looked_up_once_each(monkeypatch):
    from tokenizers import Tokenizer

    from tideline.llm import tokens

    looked_up = []

    class Counted(tokens._Numbers):
        def __getitem__(self, part):
            looked_up.append(part)
            return super().__getitem__(part)

    monkeypatch.setattr(tokens, "_Numbers", Counted)
    given = [text for _, text in texts()] + ["", None, " ", "\n", "a\n\nb  c ", " a", "b ", "\u00e9\u0301 \u2028 x"]
    plain = Tokenizer.from_file(packing_vocabulary())
    expected = [plain.encode(text or "", add_special_tokens=False).ids for text in given]
    found = tokens.WordEncoder(packing_vocabulary()).encode(given)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected
    assert len(looked_up) == len(set(looked_up))


def test_language_of_small_tables(spark, docs, nothing):
    rows = [(k, text, lang) for k, (text, lang) in enumerate(
        [("the cat and the dog with that", "en"), ("der hund und die katze mit dem", "de")] * 20
    )]
    known = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    test = spark.createDataFrame(
        [(1, "the dog and that with the cat " * 4), (2, "die katze und der hund mit dem " * 4), (3, None), (4, "12 34"), (None, "the")],
        "doc_id long, text string",
    )
    found = {r.doc_id: r for r in language.with_language(test, known).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 4)] == ["en", "de", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found.values())
    wide = language.with_language(docs, known)
    assert wide.count() == docs.count() and wide.columns.count("score") == 1
    assert language.train(nothing, F.lit(True)) == {}
    assert language.with_language(nothing, {}).count() == 0


def test_language_of_long_documents_alone_is_learned(spark):
    long = "x1 " * 9000 + "der hund und die katze mit dem " * 700 + "spaet"
    rows = [(k, "the cat and the dog with that", "en") for k in range(5)] + [(9, long, "de"), (10, None, "fr")]
    known = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert sorted(known) == ["de", "en"] and b"katze" in known["de"] and b"spaet" in known["de"]
    test = spark.createDataFrame([(1, "die katze und der hund mit dem " * 4)], "doc_id long, text string")
    assert language.with_language(test, known).first().lang_pred == "de"


def test_toxicity_of_odd_rows(spark, docs, nothing):
    labels = spark.createDataFrame([(k, k % 2) for k in range(24)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.with_toxicity(docs, toxicity.train(docs, labels), "t").select("t").collect()
    assert len(scored) == docs.count() and all(0 <= r.t <= 1 for r in scored)
    unlabelled = toxicity.train(docs, labels.filter("false"))
    assert toxicity.with_toxicity(docs, unlabelled, "t").filter("t >= 0.5").count() == 0
    assert toxicity.with_toxicity(nothing, unlabelled, "t").count() == 0


def test_numbers_that_are_no_letters_have_no_language(spark):
    known = {"en": b" the cat and the dog ", "de": b" der hund und die katze "}
    test = spark.createDataFrame(
        [(1, "\u00bd \u00b2 \u2167 \u2460"), (2, "x\u00b2"), (3, "\u4e00")], "doc_id long, text string"
    )
    found = {r.doc_id: r for r in language.with_language(test, known).collect()}
    assert (found[1].lang_pred, found[1].score) == ("und", 0.0)
    assert {found[2].lang_pred, found[3].lang_pred} <= {"en", "de"}


def test_letters_are_found_fast_and_alike():
    import time

    from tideline.llm.compression import LETTERS, words_in

    signs = [c for c in map(chr, range(0x110000)) if c.isalnum() or c == "_"]
    odd = [f"a{c}b {c}" for c in signs] + ["".join(signs)]
    assert [words_in(text) for text in odd] == [LETTERS.findall(text.lower()) for text in odd]
    prose = "some ordinary words, très ordinaires " * 5000

    def seconds(of) -> float:
        taken = []
        for _ in range(3):
            began = time.process_time()
            of(prose)
            taken.append(time.process_time() - began)
        return min(taken)

    # The plain search looks at each number sign for each letter.
    assert 3 * seconds(words_in) < seconds(LETTERS.findall)


def test_a_class_of_long_texts_alone_is_learnt(spark):
    rng = random.Random(6)
    mild = [f"mild{k}" for k in range(80)]
    foul = [f"foul{k}" for k in range(12)]
    rows = [(k, " ".join(rng.choices(mild, k=60))) for k in range(80)]
    rows += [(100 + k, " ".join(rng.choices([*mild, *foul], k=5000))) for k in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(table, labels)
    test = spark.createDataFrame(
        [(1, " ".join(rng.choices([*mild, *foul], k=4000))), (2, " ".join(rng.choices(mild, k=60)))],
        "doc_id long, text string",
    )
    found = dict(toxicity.with_toxicity(test, model, "t").select("doc_id", "t").collect())
    assert found[1] > 0.5 > found[2]


def test_fingerprints(docs, nothing):
    rows = imatch.next_document_likeness(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == by_id[200].fingerprint != by_id[2].fingerprint
    assert by_id[403].fingerprint == by_id[404].fingerprint
    edited = "one two"[:5] + "on"
    assert by_id[404].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert imatch.next_document_likeness(nothing).count() == 0


def by_hand_edited(rows):
    """Edited text of each distinct (id, text), by descending id, null last."""
    distinct = sorted(
        {(i, t or "") for i, t in rows},
        key=lambda r: (
            r[0] is None, -(r[0] or 0),
            [-b for b in hashlib.sha256(f"{'' if r[0] is None else r[0]}:{r[1]}".encode()).digest()],
        ),
    )
    edited = {}
    for k, (i, text) in enumerate(distinct):
        following = distinct[(k + 1) % len(distinct)][1]
        third = len(text) // 3
        edited[i, text] = text[: len(text) - third] + following[:third]
    return distinct, edited


@pytest.mark.parametrize("sent", [0, 10**6])
def test_edited_texts_and_likeness_equal_brute_force(docs, monkeypatch, sent):
    monkeypatch.setattr(imatch, "SENT", sent)
    rows = [(i, t or "") for i, t in texts()]
    distinct, edited = by_hand_edited(rows)
    found = imatch.next_document_likeness(docs).collect()
    assert len(found) == len(rows)
    expected = sorted(
        repr((i, len(t), hashlib.sha256(edited[i, t].encode()).hexdigest())) for i, t in rows
    )
    assert sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in found) == expected

    def likeness(a, b):
        a, b = a.split(" "), b.split(" ")
        if len(a) != len(b):
            return 0.0
        used = [(x, y) for x, y in zip(a, b) if x != "-" or y != "-"]
        return sum(x == y for x, y in used) / len(used)

    prints = {(r.doc_id, r.n_chars, r.edited_sha256): r.fingerprint for r in found}
    keys = {(i, t): (i, len(t), hashlib.sha256(edited[i, t].encode()).hexdigest()) for i, t in rows}
    by_key = {k: r for r in found for k in [(r.doc_id, r.n_chars, r.edited_sha256)]}
    for k, one in enumerate(distinct):
        r = by_key[keys[one]]
        following = distinct[(k + 1) % len(distinct)]
        assert abs(r.near_edited - likeness(r.fingerprint, r.edited_fingerprint)) < 1e-9
        assert abs(r.near_next - likeness(r.fingerprint, prints[keys[following]])) < 1e-9


def test_fingerprint_of_a_text_does_not_depend_on_the_way_of_the_join(docs, monkeypatch):
    one = sorted(map(repr, imatch.next_document_likeness(docs).collect()))
    monkeypatch.setattr(imatch, "SENT", 0)
    assert sorted(map(repr, imatch.next_document_likeness(docs).collect())) == one


def test_lexicon_is_the_band_of_exact_document_frequencies(spark):
    """More terms than a table of 2^18 buckets could tell apart; none of one document is let in."""
    rows = spark.range(400).select(
        "id",
        F.concat_ws(
            " ", F.lit("common"), F.concat(F.lit("pair"), (F.col("id") / 2).cast("long")),
            F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.concat(F.lit("own"), F.col("id"), F.lit("x"), k)),
        ).alias("text"),
    )
    expected = {r[0] for r in spark.range(200).select(F.xxhash64(F.concat(F.lit("pair"), F.col("id")))).collect()}
    assert {r.term for r in imatch.lexicon(rows).collect()} == expected


def test_fingerprints_stand_on_lexicon_terms_alone(spark):
    shared = " ".join(f"term{k}" for k in range(60))
    rows = [(k, f"{shared} single{k}") for k in range(2)]
    rows += [(10 + k, f"other{k} text{k}") for k in range(20)] + [(50, f"{shared} single50")]
    found = imatch.next_document_likeness(spark.createDataFrame(rows, "doc_id long, text string"))
    prints = {r.doc_id: r.fingerprint for r in found.collect()}
    assert len(prints) == len(rows) and prints[0] == prints[1] == prints[50]
    assert len({prints[10 + k] for k in range(20)}) == 20 and " " not in prints[10]


def test_fingerprints_are_set_hashes_of_lexicon_subsets(spark):
    rng = random.Random(12)
    names = [f"Name{k}" for k in range(300)] + [f"only{k}" for k in range(40)]
    rows = [(k, " ".join(rng.choices(names, k=rng.randint(0, 70)))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = sorted({w for _, t in rows for w in t.lower().split()})
    seeds = [F.xxhash64(F.xxhash64("w"), F.lit(s)) for s in range(imatch.SEEDS)]
    hashes = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w"), *seeds)
    hashes = {r[0]: r[1:] for r in hashes.collect()}
    seen = {w: sum(w in t.lower().split() for _, t in rows) for w in words}
    lexicon = {w for w in words if 2 <= seen[w] <= 0.2 * len(rows)}

    def fingerprint(text):
        own = lexicon & set(text.lower().split())
        if not own:
            return hashlib.sha256(text.encode()).hexdigest()[:16]
        kept = [[hashes[w][0] for w in own]]
        for seed in range(imatch.SEEDS):
            under = [hashes[w][1 + seed] for w in own]
            kept += [[h for h in under if h % 4**rate == 0] for rate in range(1, imatch.RATES + 1)]
        sums = [functools.reduce(operator.xor, one) % 2**64 if one else None for one in kept]
        return " ".join("-" if x is None else f"{x >> 32:08X}" for x in sums)

    for r in imatch.next_document_likeness(docs).collect():
        assert r.fingerprint == fingerprint(rows[r.doc_id][1])


def test_fingerprints_are_shuffled_once_to_each_document(docs, monkeypatch):
    """Texts and terms are not gathered, and fingerprints are sent as integers, to one key alone."""
    spark = docs.sparkSession
    tables = {}

    def kept(df, purpose, release=False):
        tables[purpose] = df
        return stage(df, purpose, release)

    monkeypatch.setattr(imatch, "stage", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = imatch.next_document_likeness(docs)
        plan, prints = plan_of(found), plan_of(tables["imatch-prints"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.findall(r"hashpartitioning\((\w+)#.*ENSURE_REQUIREMENTS", plan) == ["key"] * 3
    assert "collect_list" not in prints and "bit_xor" in prints
    assert dict(tables["imatch-prints"].dtypes)["own_prints"] == "array<int>"


def test_terms_of_texts_are_not_shuffled_to_a_lexicon_too_large_to_send(docs, monkeypatch):
    """Neither is the lexicon sent: it grows with the input."""
    spark = docs.sparkSession
    # Fewer than the lexicon has; the terms above the band are fewer still.
    monkeypatch.setattr(imatch, "SENT", 200)
    assert imatch.lexicon(docs).count() > 200
    plans = []

    def kept(df, purpose, release=False):
        plans.append(plan_of(df))
        return stage(df, purpose, release)

    monkeypatch.setattr(imatch, "stage", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert imatch.next_document_likeness(docs).count() == docs.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    of_texts = [p for p in plans if "array_intersect" in p]
    assert of_texts and not any("hashpartitioning(term" in p for p in of_texts)


@pytest.mark.parametrize("sent", [0, 10**6])
def test_edited_fingerprints_of_cut_words_and_common_terms(spark, monkeypatch, sent):
    """Words of one document alone, words cut in two or joined where texts meet, words in most texts."""
    monkeypatch.setattr(imatch, "SENT", sent)
    rng = random.Random(5)
    few, breaks = ["ab", "abab", "ba", "a", "b", "\u039f\u03a3", "\u03c3\u03a3a", "\u0130b", "x"], [" ", "  ", "\n", "\t ", ""]
    rows = []
    for k in range(240):
        words = [rng.choice([rng.choice(few), f"only{k}w{w}", f"pair{k // 2}"]) for w in range(rng.randint(0, 12))]
        text = rng.choice(["", " "]) + "".join(w + rng.choice(breaks) for w in words)
        rows.append((k, text + rng.choice(["", " all", "all "])))
    rows += [(300, ""), (301, "  "), (302, "y" * 50), (303, "abab"), (303, "abab"), (304, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    terms_of = docs.select(imatch._hashes(imatch.whole_text()).alias("terms")).collect()
    seen = Counter(t for r in terms_of for t in set(r.terms))
    lexicon = {t for t, n in seen.items() if 2 <= n <= 0.2 * len(rows)}
    assert any(n == 1 for n in seen.values()) and any(n > 0.2 * len(rows) for n in seen.values())
    _, edited = by_hand_edited(rows)
    wanted = spark.createDataFrame([(i, t, e) for (i, t), e in edited.items()], "doc_id long, own string, edited string")
    texts = {
        (r.doc_id, r.own): (r.edited, set(r.terms) & lexicon)
        for r in wanted.select("*", imatch._hashes(F.col("edited")).alias("terms")).collect()
    }
    every = sorted(set().union(*(t for _, t in texts.values())))
    seeded = spark.createDataFrame([(t,) for t in every], "t long").select(
        "t", *(F.xxhash64("t", F.lit(s)) for s in range(imatch.SEEDS))
    )
    seeded = {r[0]: r[1:] for r in seeded.collect()}

    def fingerprint(text, terms):
        if not terms:
            return hashlib.sha256(text.encode()).hexdigest()[:16]
        kept = [list(terms)]
        for seed in range(imatch.SEEDS):
            under = [seeded[t][seed] for t in terms]
            kept += [[h for h in under if h % 4**rate == 0] for rate in range(1, imatch.RATES + 1)]
        sums = [functools.reduce(operator.xor, one) % 2**64 if one else None for one in kept]
        return " ".join("-" if x is None else f"{x >> 32:08X}" for x in sums)

    expected = sorted(repr((i, fingerprint(*texts[i, t or ""]))) for i, t in rows)
    found = imatch.next_document_likeness(docs).collect()
    assert sorted(repr((r.doc_id, r.edited_fingerprint)) for r in found) == expected


def test_released_stages_leave_no_shuffled_data(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        folders = [Path(f) for f in manager.localDirsString()]
        return {f for folder in folders for f in folder.rglob("shuffle_*.data")}

    before = shuffled()
    held = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    assert stage(held, "released", release=True).count() == 700
    # Spark deletes in the background; the count's own shuffle, of one row, may stay.
    for _ in range(100):
        left = shuffled() - before
        if sum(f.stat().st_size for f in left if f.exists()) < 1000:
            break
        time.sleep(0.1)
    assert sum(f.stat().st_size for f in left if f.exists()) < 1000
    assert spark.conf.get(RELEASE) == "false"


def test_cross_entropy_of_odd_rows(docs, nothing):
    in_target = F.col("doc_id") < 5
    scored = cross_entropy.score(docs, in_target, documents=1)
    assert scored.columns.count("score") == 1
    rows = scored.collect()
    assert len(rows) == docs.count()
    again = cross_entropy.score(docs.repartition(5), in_target, documents=1).collect()
    assert sorted(repr((r.doc_id, round(r.score, 6))) for r in again) == sorted(
        repr((r.doc_id, round(r.score, 6))) for r in rows
    )
    unmarked = cross_entropy.score(docs, F.lit(None).cast("boolean")).collect()
    assert len(unmarked) == docs.count() and {r.score for r in unmarked} == {0.0}
    assert cross_entropy.score(nothing, in_target).count() == 0


@pytest.mark.parametrize(
    "sent_words, buckets, documents, occurrences", [(10**6, 16, 2, 1), (0, 3, 2, 2), (10**6, 16, 1, 3)]
)
def test_cross_entropy_equals_models_without_the_text(
    spark, monkeypatch, sent_words, buckets, documents, occurrences
):
    import math
    from collections import Counter

    monkeypatch.setattr(cross_entropy, "LEAST_BUCKETS", buckets)
    monkeypatch.setattr(cross_entropy, "MOST", 3)
    rng = random.Random(3)
    names = [f"word{k}" for k in range(400)]
    texts = [" ".join(rng.choices(names, k=rng.randint(1, 60))) for _ in range(150)]
    texts += [texts[0].upper(), "never seen word1 word2", "a a a a a a a a a", "", None, texts[7]]
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    in_target = (F.col("doc_id") < 60) | (F.col("doc_id") == 152)
    marks = {(r.key, r.text): r.marks for r in cross_entropy.marked(docs, in_target).collect()}
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))).alias("key"))
    own_marks = {(r.doc_id, r.text): marks[r.key, r.text or ""] for r in keyed.collect()}
    assert 20 < sum(m & 2 > 0 for m in own_marks.values()) < 120

    def words_of(text):
        return ["", *WORDS.findall((text or "").lower()), ""]

    seen = Counter(w for i, t in rows if own_marks[i, t] & 1 for w in set(words_of(t)))
    vocabulary = {w for w in seen if w == "" or seen[w] >= documents}
    size = len(vocabulary) + 1

    def counts(some):
        pairs, singles = Counter(), Counter()
        for text in some:
            own = words_of(text)
            pairs.update((a, b) for a, b in zip(own, own[1:]) if a in vocabulary and b in vocabulary)
            singles.update(w if w in vocabulary else None for w in own[1:])
        return pairs, singles

    models = [counts([t for i, t in rows if own_marks[i, t] & mark]) for mark in (1, 2)]
    together = models[0][0] + models[1][0]
    kept = {pair for pair, n in together.items() if n >= occurrences}
    models = [(Counter({p: n for p, n in m[0].items() if p in kept}), m[1]) for m in models]

    def mean_loss(text, model, mine):
        pairs, singles = (Counter(c) for c in model)
        if mine:
            own_pairs, own_singles = counts([text])
            pairs.subtract({p: n for p, n in own_pairs.items() if p in kept})
            singles.subtract(own_singles)
        total = sum(singles.values())
        own = [w if w in vocabulary else None for w in words_of(text)]
        each = [
            -math.log((pairs[a, b] + 20 * (singles[b] + 1) / (total + size)) / (singles[a] + 20))
            for a, b in zip(own, own[1:])
        ]
        return sum(each) / len(each)

    found = cross_entropy.score(docs, in_target, documents, occurrences, sent_words).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_tokens == len((r.text or "").split()) + 1
        for value, model, mark in ((r.target_loss, models[0], 1), (r.background_loss, models[1], 2)):
            assert abs(value - mean_loss(r.text, model, own_marks[r.doc_id, r.text] & mark)) < 1e-6
        assert abs(r.score - (r.target_loss - r.background_loss)) < 1e-9


def chunk_of(some, marks):
    import pyarrow as pa

    keys = pa.array(range(len(some)), pa.int64())
    return pa.RecordBatch.from_arrays([keys, pa.array(some, pa.string()), pa.array(marks, pa.int64())], names=["key", "text", "marks"])


def test_words_of_a_chunk_are_those_of_its_texts():
    import xxhash

    some = ["One one ÄÖ äö", "", None, " \t\n\v\f\r", "  a\x1cb\x85c\u00a0d\u2003e  A\x00 ", "x" * 9000, "one"]
    ids, first, second, text, marks = cross_entropy._coded(chunk_of(["cut", *some], [3] * 8).slice(1))
    assert ids[0] == cross_entropy.BORDER and len(set(ids.tolist())) == len(ids) and len(marks) == len(some)
    for k, one in enumerate(some):
        words = [xxhash.xxh3_64_intdigest(w.encode()) for w in WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), one or ""))]
        assert ids[second[text == k]].tolist() == [*words, 0]
        assert ids[first[text == k]].tolist() == [0, *words]


def test_tasks_of_cross_entropy_call_python_per_chunk_alone():
    """Neither words nor texts nor pieces are gone through one by one."""
    import cProfile

    rng = random.Random(4)
    names = [f"w{k}" for k in range(500)]
    some = [" ".join(rng.choices(names, k=rng.randint(1, 40))) for _ in range(1500)]
    batch = chunk_of(some, [k % 4 for k in range(len(some))])

    class Sent:
        value = np.zeros(1, np.uint64)

    Sent.value = np.unique(cross_entropy._coded(batch.slice(0, 20))[0])
    tasks = [cross_entropy._word_counts_task()]
    for sent in (None, Sent):
        tasks += [cross_entropy._bigram_counts_task(sent), cross_entropy._pieces_task(16, sent)]
    for task in tasks:
        profile = cProfile.Profile()
        profile.enable()
        rows = sum(len(out) for out in task(iter([batch])))
        profile.disable()
        hashed = sum(e.callcount for e in profile.getstats() if "xxh3_64" in str(e.code))
        assert rows >= 400 and sum(e.callcount for e in profile.getstats()) - hashed < 1000


def test_learnt_texts_score_like_others_of_their_kind(spark):
    rng = random.Random(8)
    kinds = [[f"good{k}" for k in range(60)], [f"poor{k}" for k in range(60)]]
    rows = [(k, " ".join(rng.choices(kinds[k % 2], k=80))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    in_target = (F.col("doc_id") % 2 == 0) & (F.col("doc_id") < 200)
    scored = cross_entropy.score(docs, in_target, documents=3).collect()
    means = {
        name: sum(own) / len(own)
        for name, own in (
            ("learnt", [r.score for r in scored if r.doc_id % 2 == 0 and r.doc_id < 200]),
            ("unseen", [r.score for r in scored if r.doc_id % 2 == 0 and r.doc_id >= 200]),
            ("poor", [r.score for r in scored if r.doc_id % 2]),
        )
    }
    assert abs(means["learnt"] - means["unseen"]) < 0.1 < 1 < means["poor"] - means["unseen"]


def test_patterns():
    text = "a.b@c.de x@y 1.2.3.4 300.1.1.1 4111 1111 1111 1111 +49 (30) 1234567 @q@r.s"
    kinds = [(pii.KINDS[k], text[a:b]) for a, k, b in pii.pattern_spans(text)]
    assert kinds == [
        ("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("phone", "+49 (30) 1234567"), ("email", "q@r.s")
    ]


def test_patterns_of_very_long_runs_of_digits():
    zeros = "0" * 6000
    text = f"{zeros}.1.1.1 {zeros}.{zeros}.{zeros}.{zeros} 1.1.1.{'9' * 6000} {'4' * 9000} +{'1' * 9000}"
    found = [(pii.KINDS[k], a, b) for a, k, b in pii.pattern_spans(text)]
    assert found == [("ip", 0, 6006), ("ip", 6007, 6007 + 24003)]


def contract_spans(text):
    """The contract's patterns as they are written, checked match by match."""

    def luhn(digits):
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted(
        (m.start(), k, m.end())
        for k, (pattern, holds) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if holds(m.group())
    )


def test_base_spans_equal_the_contract_on_all_given_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    found = 0
    for _, text in rows:
        spans = pii.pattern_spans(text or "")
        assert spans == contract_spans(text or "")
        found += len(spans)
    assert found > 50


@pytest.mark.parametrize("sent", [0, 200_000])
def test_terms_are_counted_alike_however_many_there_are(spark, monkeypatch, sent):
    monkeypatch.setattr(pii, "SENT_TERMS", sent)
    rows = spark.createDataFrame([(1, "a b  a\tc"), (2, None), (3, " b\n")], "doc_id long, text string")
    terms = spark.createDataFrame([("a",), ("b",), ("x",)], "term string")
    assert sorted(map(tuple, pii._occurrences(rows, terms).collect())) == [("a", 2), ("b", 2)]


def test_disclosing_terms_and_sanitised_texts(spark, docs, nothing):
    filler = [" ".join(f"w{(k * 7 + j) % 90}abc" for j in range(40)) for k in range(30)]
    rows = [(k, t) for k, t in enumerate(filler)]
    rows += [(50 + k, f"{filler[k]} the Zanzibarian{' ' * (k + 1)}wrote jo@ex.org {filler[k + 9]}") for k in range(4)]
    rows += [(90, "again Zanzibarian spoke"), (91, None), (None, "mail jo@ex.org")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.personal_data(table, least_bits=3.0).collect()}
    assert len(found) == len(rows)
    assert [s.kind for s in found[90].spans] == [4] and not found[90].base
    assert found[0].spans == [] and found[91].spans == []
    clean = {r.doc_id: r.text for r in pii.sanitise(table, least_bits=3.0).collect()}
    assert clean[90] == "again [term] spoke" and clean[91] is None and clean[None] == "mail [email]"
    assert pii.personal_data(docs).count() == pii.sanitise(docs).count() == docs.count()
    assert pii.personal_data(nothing).count() == pii.sanitise(nothing).count() == 0


def test_terms_of_rare_entities_at_production_thresholds(spark):
    filler = [" ".join(f"w{(k * 7 + j * 3) % 90}abc" for j in range(40)) for k in range(600)]
    rows = [(k, t) for k, t in enumerate(filler)]
    # An address seen twice, with a short name; a name beside mailboxes of one domain, each seen once.
    rows += [(1000 + k, f"{filler[k]} Li {'so' * (k + 1)} li@one.org {filler[k + 9]}") for k in range(2)]
    rows += [(1100 + k, f"{filler[k]} Okoro box{k}@two.net {filler[k + 20]}") for k in range(3)]
    rows += [(1200, "then Okoro left"), (1300, f"{filler[5]} seldom 1.2.3.4 {filler[6]}")]
    rows += [(1400, f"{filler[9]} twin 5.6.7.8 {filler[8]}"), (1401, f"{filler[9]} twin 5.6.7.8 {filler[8]}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    found = {
        r.doc_id: {text[r.doc_id][s.start : s.end] for s in r.spans if s.kind == 4}
        for r in pii.personal_data(table).collect()
    }
    assert len(found) == len(rows)
    assert found[1000] == found[1001] == {"Li"}
    assert [found[k] for k in (1100, 1101, 1102, 1200)] == [{"Okoro"}] * 4
    # One context, or copies of one, is no evidence.
    assert not any(found[k] for k in [*range(600), 1300, 1400, 1401])

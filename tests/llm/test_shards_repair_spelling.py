"""Sharding, repair of conversations and spelling variants against brute force on odd tables."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("tideline.llm")

from pyspark.sql import functions as F

from tideline.llm import repair, repair_paths, sharding, spelling

DOCS = "doc_id long, text string, number long, row string, position long, shard string, word string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in rows], DOCS)


ODD = [(k, f"text {k}") for k in range(40)] + [
    (None, None), (None, "a"), (None, "a"), (7, "text 7"), (7, "other"), (90, ""), (91, None),
    (92, "ü" * 5000), (93, "😀 x".encode("utf-16", "surrogatepass").decode("utf-16")),
]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 16, 17, 577, 2050])
def test_permutation_is_one_to_one_and_undone(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("p"))
    found = rows.withColumn("back", sharding.unpermuted(F.col("p"), n)).collect()
    assert sorted(r.p for r in found) == list(range(n))
    assert all(r.id == r.back for r in found)
    if n > 500:
        other = spark.range(n).select(sharding.permuted(F.col("id"), n, "seed").alias("p")).collect()
        assert [r.p for r in found] != [r.p for r in other] != list(range(n))


def test_shard_and_slot_are_a_formula_of_the_row_number(spark):
    n = 45
    shard, slot = sharding.shard_and_slot(F.col("id"), n, 4)
    rows = spark.range(n).select("id", shard.alias("shard"), slot.alias("slot"))
    rows = rows.withColumn("back", sharding.row_in(F.col("shard"), F.col("slot"), n, 4)).collect()
    assert all(r.id == r.back for r in rows)
    placed = sharding.shards(docs_of(spark, [(k, "x") for k in range(n)]), 4).collect()
    assert {(r.number, r.shard, r.slot) for r in placed} == {(r.id, r.shard, r.slot) for r in rows}
    assert all(r.number == r.doc_id for r in placed)


def test_shards_of_odd_rows(spark):
    docs = docs_of(spark, ODD).repartition(3)
    found = sharding.shards(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r["size"], r.text_crc32) for r in found))) == sorted(
        map(repr, ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ODD))
    )
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 16
    again = sharding.shards(docs_of(spark, ODD[::-1]).repartition(2)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    assert sharding.shards(docs.filter("false")).count() == 0


def test_a_third_of_alike_rows_is_spread(spark):
    docs = docs_of(spark, [(5, "same")] * 300 + [(k, f"own {k}") for k in range(600)])
    found = sharding.shards(docs.repartition(6), 8).collect()
    assert sorted(r.number for r in found) == list(range(900))
    assert {r.number for r in found if r.text_crc32 == zlib.crc32(b"same")} < set(range(5, 306))


def test_written_shards_keep_every_row_in_slot_order(spark, tmp_path):
    docs = docs_of(spark, ODD)
    table = sharding.write_shards(docs, f"{tmp_path}/shards", 3)
    rows = table.collect()
    assert sorted(map(repr, (r.row for r in rows))) == sorted(map(repr, docs.collect()))
    one = [(r.row.doc_id, r.shard, r.slot) for r in rows]
    assert sorted(map(repr, one)) == sorted(
        repr((r.doc_id, r.shard, r.slot)) for r in sharding.shards(docs, 3).collect()
    )
    part = spark.read.parquet(f"{tmp_path}/shards/shard=1").coalesce(1).orderBy("slot").collect()
    assert [r.slot for r in part] == list(range(len(part)))


def least_edits(codes):
    """Cost and audit by a search over (cost, audit)."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(codes) and state in (0, 3):
            return cost, audit
        due = 3 if state == 2 else 2
        heapq.heappush(heap, (cost + 3, audit + "I", i, due))
        if i == len(codes):
            continue
        fault, initial = codes[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
        if fault in ("blank", "duplicate"):
            continue
        extra = 3 * (fault == "truncated")
        heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, due))
        kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))
        if kept:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, kept))


def coded(codes):
    return bytes(
        4 * repair_paths.FAULTS.index(f) + repair_paths.INITIALS.index(i if i in ("s", "u", "a") else "")
        for f, i in codes
    )


def test_cheapest_edits_equal_a_search():
    rng = random.Random(5)
    every = [(f, i) for f in repair_paths.FAULTS for i in ("s", "u", "a", "x")]
    some = [[], *([c] for c in every)]
    some += [rng.choices(every, k=rng.randint(2, 11)) for _ in range(800)]
    likely = [("", "u"), ("", "a")] * 4 + every
    some += [rng.choices(likely, k=rng.randint(60, 150)) for _ in range(12)]
    expected = [least_edits(codes) for codes in some]
    data = [coded(codes) for codes in some]
    assert list(repair_paths.cheapest_edits(data)) == expected
    for segment in (1, 3, 64):
        assert list(repair_paths.cheapest_edits(data, segment)) == expected


def brute_repair(rows):
    """The contract's columns per conversation from plain loops, rows already damaged."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn, role, text))
    found = {}
    for conv, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in own if t is not None]
        seen, codes = set(), []
        for _, role, text in own:
            words = text.strip(" \t\n\x0b\x0c\r")
            if not words:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if words[-1] in ".!?" else "truncated"
            seen.add((role, text))
            codes.append((fault, role[:1]))
        cost, audit = least_edits(codes)
        lines, state, rest = [], 0, iter(own)
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(rest)[1:]
            if letter == "D":
                continue
            due = 3 if state == 2 else 2
            state = {"s": 1, "u": 2, "a": 3}[role[:1]] if letter == "K" else due
            lines.append(f"{role if letter == 'K' else ('user', 'assistant')[due - 2]}:{text}")
        faults = Counter(f for f, _ in codes)
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost)
        found[conv] = (*counts, audit, "\n".join(lines))
    return found


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


TURNS = "conv_id long, turn long, role string, text string, audit string, number string, part int"


def conversation_rows():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "Why? ", "half a", "", " \t", "same.", "same.", "line\nline.", "ü?", None]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randint(1, 9)):
            at = rng.choice([turn, turn, turn, turn * 3, None, 2])
            rows.append((conv, at, rng.choice(roles), rng.choice([*texts, f"own {conv} {turn}."])))
    rows += [(500, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(300)]
    rows += [(501, 1, "user", "again.")] * 40 + [(502, None, "user", "x.")]
    return rows


@pytest.mark.parametrize("piece", [4096, 7])
def test_repair_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    plain = conversation_rows()
    table = spark.createDataFrame([(*r, "x", "y", 9) for r in plain], TURNS).repartition(5)
    broken = repair.damaged(table)
    assert sorted(map(repr, map(tuple, broken.collect()))) == sorted(map(repr, damaged_by_hand(plain)))
    expected = {
        conv: (*own[:-1], hashlib.sha256(own[-1].encode()).hexdigest())
        for conv, own in brute_repair(damaged_by_hand(plain)).items()
    }
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    audits = repair.audits(broken, table)
    found = repair.with_digests(broken, audits).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {
        conv: expected.get(conv, nothing) for conv, *_ in plain
    }
    assert len(found) == len({conv for conv, *_ in plain})
    lines = defaultdict(list)
    for r in sorted(repair.repaired(broken, audits).collect(), key=lambda r: r.position):
        assert r.position == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {c: hashlib.sha256("\n".join(own).encode()).hexdigest() for c, own in lines.items()}
    assert digests == {c: e[-1] for c, e in expected.items() if e[-1] != nothing[-1]}


def test_repair_of_nothing_and_of_far_turns(spark):
    table = spark.createDataFrame([], TURNS)
    assert repair.with_digests(table, repair.audits(table, table)).count() == 0
    assert repair.repaired(table, repair.audits(table)).count() == 0
    far = spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    assert repair.audits(far).first()["gaps"] == 2**63 - 1


def brute_variants(words):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    links = {a: [b for b in words if near(a, b)] for a in words}
    form = {}
    for a, own in links.items():
        if own:
            best = min(own, key=lambda b: (-words[b], b))
            if words[best] >= 2 * words[a]:
                form[a] = best

    def root(a):
        while a in form:
            a = form[a]
        return a

    return {(a, n, len(links[a]), form.get(a), words.get(form.get(a)), root(a)) for a, n in words.items()}


@pytest.mark.parametrize("group", [1, 3, 100])
def test_variants_equal_brute_force(spark, group):
    rng = random.Random(2)
    words = {}
    for _ in range(350):
        words["".join(rng.choices("abé", k=rng.randint(5, 7)))] = rng.choice([3, 3, 4, 6, 12, 24, 50])
    stem = "wordthatisratherlong" * 3
    for k in range(0, 60, 3):
        words[stem[:k] + "x" + stem[k:]] = 3 + k
        words[stem[:k] + stem[k + 1 :]] = 5
    words |= {stem: 200, "ab": 9, "abc": 3, "a": 30}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = spelling.variant_groups(table, group).select("word", "n", "n_near", "form", "form_n", "root")
    rows = found.collect()
    assert len(rows) == len(words) and {tuple(r) for r in rows} == brute_variants(words)


def test_words_are_counted_as_damaged(spark, monkeypatch):
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcdeÉé", k=rng.randint(3, 8))) for _ in range(150)]
    rows = [(k, " ".join(rng.choices(pool, k=60)).title()) for k in range(60)]
    rows += [(None, "hello hello hello-hello"), (3, None), (4, ""), (5, "1 2 × ÷ ÷÷÷÷÷"), (6, "zz" * 9000)]
    rows += [rows[0], rows[0]]
    expected = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            expected[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    expected = {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    docs = docs_of(spark, rows).repartition(3)
    assert dict(map(tuple, spelling.count_words(docs).collect())) == expected
    nothing = spelling.variant_groups(spelling.count_words(docs.filter("false")))
    assert nothing.count() == 0


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "STRETCH", 7)
    text = "One two three fourfivesix seven " * 5 + "longestrunofall" * 4
    assert spelling.runs_of(text, 5) == Counter(
        w for w in re.findall("[a-z]+", text.lower()) if len(w) >= 5
    )

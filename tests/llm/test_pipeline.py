"""The corpus pipeline stage by stage, each on all its predecessor kept, against plain loops."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("tideline.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tideline.llm.queries import packing_vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, digest string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rng = random.Random(21)
    plain, foul = (
        ["".join(rng.choices("abcdefghiklmnoprstuvw", k=size)) for _ in range(n)]
        for size, n in ((6, 300), (8, 15))
    )

    def prose(n, of=plain):
        return " ".join(rng.choices(of, k=n))

    rows, labels = [], []
    for k in range(150):
        rows.append((k, prose(rng.randint(30, 80)), "en", "abc"[k % 3], 1, True, "x"))
        labels.append((k, 0))
    for k in range(200, 280):
        rows.append((k, prose(50, [*plain[:40], *foul]), "en", "ab"[k % 2], 1, None, None))
        labels.append((k, 1))
    texts = {row[0]: row[1] for row in rows}
    rows += [(300 + k, texts[k], "de", "c", None, None, "y") for k in range(10)]
    rows += [(400 + k, texts[k] + " tail end", None, None, 2, None, None) for k in range(20, 40)]
    rows += [(20, texts[20], "en", "c", 1, True, "x"), (20, prose(40), "en", "c", 1, True, "x")]
    rows += [(500, None, None, None, None, None, None), (501, "", "en", "a", 0, None, None)]
    rows += [(None, prose(35), "en", "b", 3, None, None), (502, prose(6000), "fr", "b", 9, False, "z")]
    return rows, labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, by its name, the input under "documents"."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    found = {"documents": rows}
    current = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        step(spark, current, folder).write.parquet(f"{folder}/{name}")
        current = spark.read.parquet(f"{folder}/{name}")
        found[name] = [tuple(row) for row in current.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == docs.columns
    found["pieces"] = current.collect()
    found["run"] = corpus_pipeline.run(spark, folder).count()
    return found


def test_toxic_documents_go_and_others_stay(stages):
    kept = Counter(stages["toxicity"])
    assert not kept - Counter(stages["documents"])
    gone = [row[0] for row in (Counter(stages["documents"]) - kept).elements()]
    toxic = set(range(200, 280))
    assert len(toxic & set(gone)) >= 76 and len(set(gone) - toxic) <= 4


def test_of_equal_texts_the_largest_id_stays(stages):
    groups = defaultdict(list)
    for row in stages["toxicity"]:
        groups[row[1] or ""].append(row)
    kept = {row[1] or "": row for row in stages["exact_dedup"]}
    assert len(kept) == len(stages["exact_dedup"]) == len(groups)
    for text, rows in groups.items():
        ids = [row[0] for row in rows if row[0] is not None]
        assert kept[text] in rows and kept[text][0] == max(ids, default=None)


def test_one_of_each_group_of_near_copies_stays(stages):
    def shingles(text):
        words = WORDS.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    rows = stages["exact_dedup"]
    sets = [shingles(row[1]) for row in rows]
    least = {row[0]: row[0] for row in rows if row[0] is not None}
    changed = True
    while changed:
        changed = False
        for (i, *_), a in zip(rows, sets):
            for (j, *_), b in zip(rows, sets):
                if i is None or j is None or not a or not b or least[i] <= least[j]:
                    continue
                if 100 * len(a & b) >= 75 * len(a | b):
                    least[i], changed = least[j], True
    linked = {i for (i, *_), a in zip(rows, sets) if i is not None and a and least[i] != i}
    expected = [row for row in rows if row[0] not in linked]
    assert linked and Counter(stages["minhash_dedup"]) == Counter(expected)


def test_sources_come_near_their_targets(stages):
    before, after = Counter(stages["minhash_dedup"]), Counter(stages["mixing"])
    size = {row: len(WORDS.findall(row[1] or "")) for row in before}
    assert all(row in before and n <= 3 * before[row] for row, n in after.items())
    total = sum(size[row] * n for row, n in before.items())
    assert abs(sum(size[row] * n for row, n in after.items()) - total) < 3 * max(size.values())


def test_every_id_of_the_mix_is_in_one_window(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing_vocabulary())
    expected = Counter()
    for row in stages["mixing"]:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        expected[row[0]] += len(ids) + 1
    lengths, windows = Counter(), defaultdict(list)
    for piece in stages["pieces"]:
        assert len(piece.ids) == 4 * piece.length > 0
        lengths[piece.doc_id] += piece.length
        windows[piece.sequence_id].append((piece.offset, piece.length))
    assert lengths == expected
    for own in windows.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert stages["run"] == len(stages["pieces"])


def test_empty_tables_give_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

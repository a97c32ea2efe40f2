import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import documents, prose, rows_of
from pyspark.sql import functions as F

from ledgerwalk.llm import encode, packing
from ledgerwalk.llm.encode import Encoder
from ledgerwalk.llm.packed_ids import RoomTree, best_fit_decreasing, packed_ids_report, write_packed_ids
from ledgerwalk.llm.packing import best_fit, pack_documents, packing_report
from ledgerwalk.llm.token_counts import count_tokens, read_cache, token_count_report, tokenizer_digest

tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE, PIECE = (tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def library_ids(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = list("abcXYZ éÉßİΣςσ \n\t.,'!?0123456789<|>#_-\r\x0b") + [
    "<|endoftext|>", "<|startoftext|>", "<|endoftext|", "  ", "'s", "it's", "word.", "Word,", "́", "​", "　",
    "日本", "한", "ŉ", "ǆ", "😀", "\xa0", "\x1c", "\x85", "﻿", " ", "ſ", "K", "Å", "﷽"]


@pytest.mark.parametrize("path", [WORD, BYTE, PIECE])
def test_ids_are_the_library_s(path):
    rnd, enc = random.Random(11), Encoder(path)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    texts += ["", " ", "a", prose(1, 3000), prose(2, 200).title() + ".", "x" * 30_000, "no space " * 4000]
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert [np.frombuffer(b, dtype=np.uint32).tolist() for b in enc.ids(part)] == library_ids(path, part)


def altered(path, tmp_path, change):
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    change(spec)
    out = tmp_path / "altered.json"
    out.write_text(json.dumps(spec), encoding="utf-8")
    return str(out)


def added(content, **options):
    def change(spec):
        n = max(spec["model"]["vocab"].values()) + 100
        spec["added_tokens"].append({"id": n, "content": content, "single_word": False, "lstrip": False, "rstrip": False,
                                     "normalized": False, "special": True} | options)
        spec["model"]["vocab"][content] = n
    return change


ALTERED = {
    "no normaliser": (WORD, lambda s: s.update(normalizer=None)),
    "NFC alone": (WORD, lambda s: s.update(normalizer={"type": "NFC"})),
    "lower case first": (WORD, lambda s: s["normalizer"]["normalizers"].insert(0, {"type": "StripAccents"})),
    "digits together": (WORD, lambda s: s["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(
        Regex=r"'s|[\p{L}]+|[\p{N}]+|[^\s\p{L}\p{N}]+")),
    "a word is added": (WORD, added("hello")), "a part of a word is added": (WORD, added("orl", normalized=True)),
    "a word and stop are added": (WORD, added("d.")), "a stop is added": (BYTE, added(".")),
    "a word is added to bytes": (BYTE, added("Hello")), "it takes the space before it": (BYTE, added("<x>", lstrip=True)),
    "a space before the text": (BYTE, lambda s: s["pre_tokenizer"].update(add_prefix_space=True)),
    "lower case for bytes": (BYTE, lambda s: s.update(normalizer={"type": "Lowercase"})),
    "no pattern": (BYTE, lambda s: s["pre_tokenizer"].update(use_regex=False)),
    "another sign is added": (WORD, added("<x>")),
}


@pytest.mark.parametrize("name", ALTERED)
def test_altered_tokenizers_give_the_library_s_ids(name, tmp_path):
    path = altered(*(ALTERED[name][0], tmp_path, ALTERED[name][1]))
    rnd, enc = random.Random(3), Encoder(path)
    texts = ["Hello World again", "hello world. hello, world.", "a <x> b<x>", "É é 2024 12", " lead", "", "worldhello"]
    texts += ["".join(rnd.choice(ODD + ["hello", "Hello", "World", "world."]) for _ in range(30)) for _ in range(200)]
    assert [np.frombuffer(b, dtype=np.uint32).tolist() for b in enc.ids(texts)] == library_ids(path, texts)
    assert enc.mode == ("space" if name == "another sign is added" else "whole")


def test_the_given_files_take_the_fast_paths():
    assert [Encoder(p).mode for p in (WORD, BYTE, PIECE)] == ["space", "byte", "whole"]


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(encode, "MEMO_CHUNKS", 20)
    texts = [prose(s, 60) for s in range(30)]
    for path in (WORD, BYTE):
        enc = Encoder(path)
        for t in texts:
            assert np.frombuffer(enc.ids([t])[0], dtype=np.uint32).tolist() == library_ids(path, [t])[0]
            assert len(enc.first) <= 20 and len(enc.later) <= 20


ROWS = [(1, "Hello, world."), (2, None), (3, ""), (4, "Hello, world."), (5, prose(3, 700)), (6, "é ß  x\n"), (None, "null id"),
        (7, "a<|endoftext|>b"), (8, prose(4, 15_000)), (8, "repeated id"), (8, "repeated id")]


def test_counts_and_cache(spark, tmp_path):
    cache = str(tmp_path / "cache")
    df = documents(spark, ROWS, clashing=True)
    want = sorted(((i, len((t or "").encode()), len(ids)) for (i, t), ids in zip(ROWS, library_ids(BYTE, [t for _, t in ROWS]))),
                  key=str)
    for _ in range(2):  # the second time from the cache
        assert sorted((tuple(r) for r in count_tokens(df, BYTE, cache).collect()), key=str) == want
        stored = read_cache(spark, cache, tokenizer_digest(BYTE))
        assert stored.count() == stored.select("digest").distinct().count() == 8
    assert read_cache(spark, cache, "another version").count() == 0
    more = documents(spark, [(20, "new text"), (21, "Hello, world.")])
    assert {r["id"]: r["n_tokens"] for r in count_tokens(more, BYTE, cache).collect()} == {20: 2, 21: 4}
    assert read_cache(spark, cache, tokenizer_digest(BYTE)).count() == 9


def test_a_digest_that_two_runs_appended_counts_once(spark, tmp_path):
    cache = str(tmp_path / "cache")
    df = documents(spark, [(1, "some text"), (2, "some text"), (3, "other")])
    want = sorted(tuple(r) for r in count_tokens(df, BYTE, cache).collect())
    spark.read.parquet(cache).cache().write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert read_cache(spark, cache, tokenizer_digest(BYTE)).count() == 4
    assert sorted(tuple(r) for r in count_tokens(df, BYTE, cache).collect()) == want


def test_only_misses_are_encoded(spark, tmp_path):
    """A count that is in the cache is used as it stands."""
    cache = str(tmp_path / "cache")
    known = spark.createDataFrame([("known",)], "text string").select(
        F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(777).cast("long").alias("n_tokens"),
        F.lit(tokenizer_digest(BYTE)).alias("tokenizer"))
    known.write.partitionBy("tokenizer").parquet(cache)
    got = {r["id"]: r["n_tokens"] for r in count_tokens(documents(spark, [(1, "known"), (2, "other")]), BYTE, cache).collect()}
    assert got == {1: 777, 2: 1}


def test_count_report_and_empty_table(spark):
    got = {r["doc_id"]: r for r in token_count_report(documents(spark, [(1, prose(3, 700)), (2, "a")]), BYTE).collect()}
    assert got[1]["over_limit"] and not got[2]["over_limit"] and got[2]["n_bytes"] == 1
    assert token_count_report(documents(spark, []), BYTE).collect() == []
    piece = token_count_report(documents(spark, [(1, "Hello")]), PIECE).first()
    assert piece["n_tokens"] == len(library_ids(PIECE, ["Hello"])[0])


def check_packing(rows, docs, capacity, end_id=1):
    want = {}
    for (i, t), ids in zip(docs, library_ids(WORD, [t for _, t in docs])):
        ids = np.array(ids + [end_id], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.setdefault((i, k, at, len(part), zlib.crc32(part.tobytes())), []).append(0)
    got, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        got[tuple(r[c] for c in (r.__fields__[0], "piece", "start", "length", "ids_crc32"))].append(0)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert dict(got) == want
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_is_lossless_and_tight(spark, monkeypatch):
    docs = [(i, prose(i, 5 + (i * 37) % 400)) for i in range(300)] + ROWS
    total = sum(len(x) + 1 for x in library_ids(WORD, [t for _, t in docs]))
    df = documents(spark, docs, clashing=True).repartition(40)
    for fan_in in (8, 2):
        monkeypatch.setattr(packing, "FAN_IN", fan_in)
        n = check_packing(packing_report(df, WORD).collect(), docs, 4096)
        assert n <= 1.08 * total / 4096 + 1  # forty tasks of one or two sequences each


def test_packing_few_passed_on_and_small_capacity(spark, monkeypatch):
    monkeypatch.setattr(packing, "PASS_ON", 3)
    docs = [(i, prose(i, 12)) for i in range(200)]
    check_packing(pack_documents(documents(spark, docs).repartition(9), WORD, 1, capacity=50).collect(), docs, 50)
    assert packing_report(documents(spark, []), WORD).collect() == []
    assert packing_report(documents(spark, [(1, None)]), WORD).first()["length"] == 1


@pytest.mark.parametrize("long, short, per_long, least", [(21, 19, 1, 120), (30, 10, 1, 120), (36, 2, 2, 120)])
def test_packing_of_files_in_order_of_length(spark, monkeypatch, long, short, per_long, least):
    """Pieces of one split meet those of all others: files sorted by length need no more sequences."""
    docs = [(i, " ".join(["a"] * (long - 1))) for i in range(120)]
    docs += [(1000 + i, " ".join(["a"] * (short - 1))) for i in range(120 * per_long)]
    df = documents(spark, docs).repartitionByRange(6, "doc_id")
    assert check_packing(pack_documents(df, WORD, 1, capacity=40).collect(), docs, 40) == least
    monkeypatch.setattr(packing, "TASK_PIECES", 60)
    tasks = -(-len(docs) // 60)
    assert check_packing(pack_documents(df, WORD, 1, capacity=40).collect(), docs, 40) <= least + 2 * tasks


@pytest.mark.parametrize("lengths", [[30], [26, 28, 30], [22] * 5 + [39] * 2])
def test_each_task_passes_on_the_emptiest_bins_and_no_more(spark, monkeypatch, lengths):
    """Equal fills too: as many go up as may, and those that go are the emptiest."""
    monkeypatch.setattr(packing, "TASK_PIECES", 20)
    monkeypatch.setattr(packing, "PASS_ON", 4)
    stored, store = {}, packing.store

    def kept(df, name):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(packing, "store", kept)
    docs = [(i, " ".join(["a"] * (lengths[i % len(lengths)] - 1))) for i in range(700)]
    check_packing(pack_documents(documents(spark, docs), WORD, 1, capacity=40).collect(), docs, 40)
    seen = {k: v.collect() for k, v in stored.items()}
    for level in range(1, 3):
        below, here = (defaultdict(dict) for _ in range(2))
        for r in seen[f"pack-{level - 1}"]:
            below[r["task"]][r["sequence_id"]] = r["fill"]
        for r in seen[f"pack-{level}"]:
            here[r["task"]][r["sequence_id"]] = r["fill"]
        want = Counter()
        for task, fills in below.items():
            want.update({task // packing.FAN_IN: sum(sorted(f for f in fills.values() if f < 39)[:4])})
        assert {t: sum(f.values()) for t, f in here.items()} == want
        assert max(map(len, here.values())) <= 4 * packing.FAN_IN


def test_packing_spreads_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 50)
    docs = [(None, "a b")] * 200 + [(7, "a b c")] * 200
    rows = pack_documents(documents(spark, docs).repartition(3), WORD, 1, capacity=11).collect()
    check_packing(rows, docs, 11)
    tasks = Counter(r["sequence_id"] >> 32 & 0xffffff for r in rows if r["sequence_id"] >> 56 == 0)
    assert len(tasks) == 8 and max(tasks.values()) <= 60


def test_best_fit_takes_the_fullest_bin_that_holds():
    bins, offsets, fill = best_fit([7, 6, 3, 4, 10, 1], 10)
    assert bins == [0, 1, 0, 1, 2, 3] and offsets == [0, 0, 7, 6, 0, 0] and fill == [10, 10, 10, 1]
    rnd = random.Random(2)
    for _ in range(50):
        lengths = [rnd.randint(1, 40) for _ in range(rnd.randint(0, 60))]
        free, want = [], []
        for n in lengths:
            fits = [f for f in free if f >= n]
            room = min(fits) if fits else 40
            if fits:
                free.remove(room)
            want.append(room - n)
            free.append(room - n)
        bins, offsets, fill = best_fit(lengths, 40)
        assert [40 - o - n for o, n in zip(offsets, lengths)] == want


def test_room_tree_and_best_fit_decreasing():
    tree = RoomTree(20)
    rnd, rooms = random.Random(3), []
    for step in range(400):
        if rnd.random() < 0.5:
            room = rnd.randint(0, 20)
            tree.push(room, step)
            rooms.append(room)
        else:
            need = rnd.randint(0, 20)
            fits = [r for r in rooms if r >= need]
            got = tree.pop_at_least(need)
            assert (got and got[0]) == (min(fits) if fits else None)
            if fits:
                rooms.remove(got[0])
    rows = best_fit_decreasing([4, 8, 1, 4, 2, 1], 10)
    assert sorted(i for r in rows for i in r) == list(range(6)) and len(rows) == 2


def test_packed_ids_round_trip(spark, tmp_path, monkeypatch):
    from ledgerwalk.llm import packed_ids

    monkeypatch.setattr(packed_ids, "WINDOW_TOKENS", 2000)
    docs = [(i + 100, prose(i, 5 + (i * 37) % 300)) for i in range(80)] + [r for r in ROWS if r[0] != 8] + [(8, prose(4, 15_000))]
    df = documents(spark, docs, clashing=True)
    for width, id_bytes in ((256, 2), (4096, 4)):
        out = write_packed_ids(df.repartition(3), str(tmp_path / f"ids{width}"), WORD, 1, width=width, id_bytes=id_bytes).collect()
        back = defaultdict(dict)
        for r in out:
            ids = np.frombuffer(r["ids"], dtype=f"<u{id_bytes}")
            assert len(ids) == width == r["width"] and not ids[r["n_tokens"]:].any()
            cu = r["cu_seqlens"]
            assert cu[0] == 0 and cu[-1] == r["n_tokens"] and r["position_resets"] == cu[:-1]
            for d, start, a, b in zip(r["doc_ids"], r["doc_starts"], cu, cu[1:]):
                assert start not in back[d]
                back[d][start] = ids[a:b].tolist()
        want = {i: ids + [1] for (i, _), ids in zip(docs, library_ids(WORD, [t for _, t in docs]))}
        assert {d: [x for s in sorted(p) for x in p[s]] for d, p in back.items()} == want
        total = sum(map(len, want.values()))
        assert len(out) <= total / width * 1.1 + 3
    assert packed_ids_report(documents(spark, []), WORD).collect() == []
    assert rows_of(packed_ids_report(documents(spark, [(1, None)]), WORD), "n_tokens", "doc_ids") == [(1, [1])]


def test_packed_rows_do_not_depend_on_the_order_of_files(spark, tmp_path, monkeypatch):
    from ledgerwalk.llm import packed_ids

    docs = [(i, " ".join(["a"] * (29 if i < 120 else 9))) for i in range(240)]
    df = documents(spark, docs).repartitionByRange(6, "doc_id")

    def rows(name):
        out = write_packed_ids(df, str(tmp_path / name), WORD, 1, width=40).collect()
        assert sorted(d for r in out for d in r["doc_ids"]) == list(range(240))
        return len(out)

    assert rows("one") == 120
    monkeypatch.setattr(packed_ids, "WINDOW_TOKENS", 1)
    monkeypatch.setattr(packed_ids, "TASK_ROWS", 60, raising=False)
    assert rows("several") <= 120 + 2 * 5  # five tasks


@pytest.mark.parametrize("path", [WORD, PIECE])
@pytest.mark.parametrize("ids", [{"end_id": 70_000}, {"end_id": 1, "pad_id": -1}, {"end_id": 1, "id_bytes": 1}])
def test_ids_that_do_not_fit_are_an_error(spark, tmp_path, path, ids):
    with pytest.raises(ValueError, match="doesn't fit"):
        write_packed_ids(documents(spark, [(1, "a")]), str(tmp_path / "ids"), path, **ids)
    assert not (tmp_path / "ids").exists()

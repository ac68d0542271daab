import random
import zlib

import numpy as np
import pytest

from tabwarden.llm import packing, queries

from .helpers import documents


def check(rows, want, window):
    """Each document's ids lie in exactly one piece each; sequences are gapless and full, or a power of two long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert r["length"] > 0 and r["doc_tokens"] == len(want[r["id"]])
    assert by_doc.keys() == want.keys()
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        assert [p["start"] for p in pieces] == list(np.cumsum([0] + [p["length"] for p in pieces])[:-1])
        assert [t for p in pieces for t in p["ids"]] == list(want[i])
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        total = 0
        for p in pieces:
            assert p["offset"] == total
            total += p["length"]
        assert total <= window and (total == window or total & (total - 1) == 0)


@pytest.mark.parametrize("most_open", [1, 3, 256])
def test_sum_of_squares(most_open):
    r = random.Random(most_open)
    want = {i: [r.randrange(1000) for _ in range(r.choice([1, 2, 17, 40, 63, 64, 65, 200]))] for i in range(300)}
    packer, rows = packing.SumOfSquares(64, most_open), []

    def take(closed):
        for pieces in closed:
            offset = 0
            for (i, total), start, ids in pieces:
                rows.append({"id": i, "start": start, "length": len(ids), "ids": list(ids), "doc_tokens": total, "sequence_id": len({x["sequence_id"] for x in rows}) if not offset else rows[-1]["sequence_id"], "offset": offset})
                offset += len(ids)

    for i, ids in want.items():
        take(packer.add((i, len(ids)), np.array(ids)))
        assert packer.open <= most_open and packer.counts.sum() == packer.open
    take(packer.finish())
    check(rows, want, 64)


def test_packing_matches_the_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer

    r = random.Random(1)
    odd = ["Don't  STOP'LL we 've", "été ́x", "<|endoftext|> a<|startoftext|>b", "　full width\x1cand\x85more", "ΣΣΣ İstanbul 12 345,6", "\U0001f600\U0001f600!!", "x" * 3000, "a\x0bb\x0cc\rd"]
    texts = [None, "", " \n"] + odd + [" ".join("".join(r.choice("abcdeé'.,1") for _ in range(r.randint(1, 9))) for _ in range(r.choice([1, 50, 900, 6000]))) for _ in range(40)]
    tokenizer = Tokenizer.from_file(queries.word_tokenizer())
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    rows = packing.packed(documents(spark, texts).repartition(3, "doc_id"), queries.word_tokenizer()).collect()
    check([r.asDict() | {"ids": np.frombuffer(r.ids, "<u4").tolist()} for r in rows], want, 4096)
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op6_packing(spark, str(tmp_path)).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_forgotten_words_and_nothing(spark):
    words = packing.WordTokens(queries.word_tokenizer(), remember=3)
    for text in ("a b c d e", "f g a", None):
        assert words.encode([text], 2)[0].tolist() == packing.WordTokens(queries.word_tokenizer()).encode([text], 2)[0].tolist()
    assert packing.packed(documents(spark, []), queries.word_tokenizer()).count() == 0


def test_rows_without_an_id_and_clashing_columns(spark):
    rows = [(None, "a b c", 1, b"x"), (None, "a b c", 2, b"y"), (5, None, 3, None), (5, "d", 4, None)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string, start int, ids binary").coalesce(1), queries.word_tokenizer()).collect()
    whole = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        whole.setdefault((r.id, r.doc_tokens), []).append(r.length)
    assert {k: sum(v) for k, v in whole.items()} == {k: k[1] * (2 if k[0] is None else 1) for k in whole} and {k[0] for k in whole} == {None, 5}

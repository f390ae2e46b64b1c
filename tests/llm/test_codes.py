import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm.codes import CodedFile, encode_file, read_coded, write_coded
from riskloom.llm.queries import op5_token_codes

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
plain = Tokenizer.from_file(PATH)
plain.encode_special_tokens = True


@pytest.mark.parametrize("most", [1, 200, 256, 257, 70_000, 1 << 33])
@pytest.mark.parametrize("count", [0, 1, 511, 512, 513, 5000])
def test_every_position_is_addressable(most, count):
    ids = np.random.default_rng(count).integers(0, most, count).astype(np.uint64)
    starts = np.array([0, count // 3, count], np.int64)
    data = encode_file(ids, np.array([-5, 7], np.int64), starts)
    reads = []

    def read(at, length):
        assert at + length <= len(data)
        reads.append(length)
        return data[at : at + length]

    coded = CodedFile(read)
    assert coded.documents()[0].tolist() == [-5, 7] and coded.documents()[1].tolist() == starts.tolist()
    assert coded.ids(0, count).tolist() == ids.tolist()
    reads.clear()
    for i in range(0, count, 97):
        assert coded.id_at(i) == ids[i]
    assert not reads or max(reads) <= 64  # never more than the bits of one block
    for low, high in [(0, 0), (count // 2, count), (count // 3, count // 2)]:
        assert coded.ids(low, high).tolist() == ids[low:high].tolist()
    with pytest.raises(IndexError):
        coded.ids(0, count + 1)


def expected(docs, end):
    place, out = 0, {}
    for doc, text in docs:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, end]
        out.setdefault(doc, []).append((place, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        place += len(ids)
    return out


def test_query_matches_the_library(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = op5_token_codes(spark, SMALL).collect()
    assert {r.doc_id: [(r.start, r.n_tokens, r.ids_crc32)] for r in got} == expected(docs, 2)
    assert len(got) == len(docs)


def test_nulls_repeats_long_texts_and_small_files(rows):
    data = [(4, "a b c", "x"), (None, None, "y"), (2, "", None), (4, "a b c", "x"), (9, "word " * 30_000, "z")]
    files = write_coded(rows(data, "doc_id long, text string, start string"), PATH, 2, file_ids=3)
    got = {}
    for r in read_coded(files).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, zlib.crc32(r.ids)))
    docs = sorted([(d, t) for d, t, _ in data], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert {k: sorted(v) for k, v in got.items()} == expected(docs, 2)
    assert files.count() > 1


def test_no_documents(rows):
    assert read_coded(write_coded(rows([], "doc_id long, text string"), PATH, 2)).count() == 0

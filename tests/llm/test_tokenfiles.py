import random
import uuid
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanmill.llm import tokenfiles

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", " a", "a ", "a  b", "\n", "a \nb c", "x᠎ ᠎y z", "don't can't it's 'tis", "a b c d",
    "１２ ３２ ab", "é é x", "a\x1c b \x1dc", "<|endoftext|> b <|endoftext|>", "漢字 かな ü😀 😀 x", "a.\nB c\n", "a\n\nb c",
    "tab\tx y", " x y  z", "A1b2 c3 $$ 12,5 (x) --", "Ǆ ȳ ɏ ɐ", "the the the", "x" * 3000 + " " + "y" * 3000, "\r\n a\r\nb",
    "a b\u0085c d", "ß ÿ × ÷ a÷b", "٣ ३ x٣", "word 's 'S ' ''",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return found


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def encoded(encoder, texts):
    ids, sizes = encoder(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    return [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]


def test_words_apart_have_the_ids_of_whole_texts(library, monkeypatch):
    rng = random.Random(6)
    kinds = ["a", "Zé", "ß", "1", "22", ".", "!?", "'", "'s", "\n", " ", "  ", " ", "\x1c", "᠎", "漢", "😀", "\t", "ɏ", "ɐ", "٣"]
    texts = ODD + ["".join(rng.choice(kinds) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 25))) for _ in range(4000)]
    want = [ids_of(library, t) for t in texts]
    encoder = tokenfiles.Encoder(VOCABULARY)
    assert encoded(encoder, texts) == want
    assert encoded(encoder, texts) == want  # from what it remembers
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 50)
    assert [encoded(encoder, texts[i : i + 9]) for i in range(0, 900, 9)] == [want[i : i + 9] for i in range(0, 900, 9)]
    assert encoded(encoder, []) == []


def by_force(library, rows, end=2):
    known = [(i, [*ids_of(library, t), end]) for i, t in rows]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    known.sort(key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), crc(r[1])))
    out, start = [], 0
    for i, ids in known:
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def listed(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=lambda r: r[1])


def test_digests(edge_documents, edge_rows, library):
    assert listed(tokenfiles.digests(edge_documents, VOCABULARY)) == by_force(library, edge_rows)


def test_digests_of_given_documents(some_documents, library):
    rows = [(r.doc_id, r.text) for r in some_documents.collect()]
    assert listed(tokenfiles.digests(some_documents, VOCABULARY)) == by_force(library, rows)


@pytest.fixture
def folder(spark, tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


def test_wide_ids(spark, folder, library):
    """An end id beyond 16 bits: ids are packed in 32."""
    docs = spark.createDataFrame([(1, "one two"), (2, "")], "doc_id long, text string")
    tokenfiles.write(docs, folder, VOCABULARY, 70_000)
    got = {r.doc_id: list(r.ids) for r in tokenfiles.read(spark, folder).collect()}
    assert got == {1: [*ids_of(library, "one two"), 70_000], 2: [70_000]}


def test_no_rows(no_documents):
    assert tokenfiles.digests(no_documents, VOCABULARY).count() == 0


def test_many_parts_and_one_id(spark, library, folder, monkeypatch):
    """Parts are small, an id has a third of the rows, groups of parts are small."""
    monkeypatch.setattr(tokenfiles, "PARTS_TOGETHER", 3)
    monkeypatch.setattr(tokenfiles, "TOGETHER", 500)
    rng = random.Random(1)
    rows = [(i if i % 3 else 30, " ".join(rng.choices(["one", "zwei", "trois."], k=i % 40))) for i in range(900)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, part int, start int")
    tokenfiles.write(docs, folder, VOCABULARY, 2, tokenfiles.Layout(part_tokens=1500))
    assert tokenfiles.parts(spark, folder).count() > 8
    got = listed(tokenfiles.checked(tokenfiles.read(spark, folder)))
    assert got == by_force(library, rows)
    files = sorted(Path(f"{folder}/tokens").glob("part-*.parquet"))
    ids = [i for f in files for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    assert len(files) > 8 and ids == sorted(ids)


def test_encodings_groups_and_page_indexes(spark, folder):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["one", "zwei", "trois.", "quatre"], k=rng.randint(50, 90)))) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    layout = tokenfiles.Layout(group_bytes=128 << 10, page_rows=200)
    tokenfiles.write(docs, folder, VOCABULARY, 2, layout)
    meta = pq.ParquetFile(next(Path(f"{folder}/tokens").glob("part-*.parquet"))).metadata
    assert meta.num_row_groups > 2
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert all(c.has_offset_index and c.has_column_index for n, c in columns.items() if not n.startswith("ids"))
    assert columns["ids.list.element"].has_offset_index
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    for name in ("doc_id", "start", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in columns[name].encodings


def test_selective_reads(spark, library, folder):
    rows = [(i, f"text number {i} of a corpus") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenfiles.write(docs, folder, VOCABULARY, 2, tokenfiles.Layout(part_tokens=5000, page_rows=50))
    some = tokenfiles.read(spark, folder, F.col("doc_id").between(700, 705)).select("doc_id", "n_tokens")
    assert {r.doc_id for r in some.collect()} == set(range(700, 706))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].splitlines()[0] and "GreaterThanOrEqual(doc_id,700)" in plan
    stream = [t for _, text in rows for t in [*ids_of(library, text), 2]]
    for a, b in ((0, 1), (4990, 5030), (len(stream) - 3, len(stream) + 9), (7, 7), (len(stream), len(stream) + 1)):
        found = tokenfiles.stretch(spark, folder, a, b).orderBy("start").collect()
        assert [t for r in found for t in r.ids] == stream[a:b]
        assert not found or found[0].start == a

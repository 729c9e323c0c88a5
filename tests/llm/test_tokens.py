import glob
import random
import struct
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import orc
from tests.llm.helpers import documents, frame
from touchline.llm import packing, registry, token_orc, tokens
from touchline.llm.common import clean_texts, slices, work_path

WORD, PIECE = registry.tokenizer_path("word_bpe_49k.json"), registry.tokenizer_path("piece_bpe_32k.model")
ODD = ["a", "B", "é", "é", "Σ", "σ", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "1", "９", "　", " ", "▁", "<|endoftext|>", "<s>", "İ", "ß", "😀", "...", "!.", "中", "\x00", "\x1c", "\x85", "|", "\r", "don't", "***", "%,", "é!!", "Ł,", "x|>", "_", "Ab."]


@pytest.mark.parametrize("seed", range(5))
def test_encoding_by_word_equals_whole_texts(seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(400)] + ["x" * 5000, "word " * 3000]
    word, piece = tokens.tokenizer(WORD), tokens.tokenizer(PIECE)
    assert word.by_word and piece.by_word
    ids, starts = tokens.encode_slice(word, pa.array(texts))
    n = tokens.count_slice(piece, pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == word.inner.encode(t, add_special_tokens=False).ids, t
        assert n[i] == len(piece.inner.encode(t)), t


def test_counts(spark):
    rows = documents() + [(None, "no id"), (70, "again"), (70, "again")]
    got = sorted(map(tuple, tokens.token_counts(frame(spark, rows), PIECE, 100).collect()), key=str)
    count = lambda t: len(tokens.tokenizer(PIECE).inner.encode(t or ""))
    assert got == sorted(((i, len((t or "").encode()), count(t), count(t) > 100) for i, t in rows), key=str)
    assert tokens.token_counts(frame(spark, []), PIECE).count() == 0


def encoded(text, end):
    return [*tokens.tokenizer(WORD).inner.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_orc_round_trip(spark):
    rows = documents()
    path = work_path(spark, "tokens")
    token_orc.write_token_orc(frame(spark, rows), path, WORD, 1, files=4)
    want, start = [], 0
    for i, t in sorted(rows):
        ids = encoded(t, 1)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, token_orc.token_offsets(spark, path).collect())) == want
    back = {r.doc_id: r.ids for r in token_orc.read_token_orc(spark, path, [5, 9]).collect()}
    assert back == {i: encoded(t, 1) for i, t in rows if i in (5, 9)}
    plan = token_orc.read_token_orc(spark, path, [5, 9])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id, [5,9])]" in plan


def test_orc_of_nothing(spark):
    path = work_path(spark, "tokens")
    token_orc.write_token_orc(frame(spark, []), path, WORD, 1)
    assert token_orc.token_offsets(spark, path).count() == 0


def check_packing(packed, rows, capacity, end):
    want = {}
    for i, t in rows:
        ids = encoded(t, end)
        for p, at in enumerate(range(0, len(ids), capacity)):
            want[i, p] = (at, len(ids[at : at + capacity]), crc(ids[at : at + capacity]))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed} == want and len(packed) == len(want)
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(spark):
    rows = documents()
    packed = packing.pack_documents(frame(spark, rows), WORD, 256, 0).collect()
    used = check_packing(packed, rows, 256, 0)
    total = sum(len(encoded(t, 0)) for _, t in rows)
    assert used <= total / 256 * 1.02 + 1
    lines = packing.sequences(packing.pack_documents(frame(spark, rows), WORD, 256, 0)).collect()
    assert sum(r.n_ids for r in lines) == total and all(len(r.ids) == 4 * r.n_ids for r in lines)
    assert packing.pack_documents(frame(spark, []), WORD, 256, 0).count() == 0
    assert packing.pack_documents(frame(spark, [(1, "a b"), (1, "a b"), (None, None)]), WORD, 256, 0).select("sequence_id").distinct().count() == 1


def check_plan(counts, capacity):
    got, placed = packing.plan(counts, capacity), {}
    for config, n in got:
        assert n > 0 and sum(s * a for s, a in config) <= capacity
        for s, a in config:
            placed[s] = placed.get(s, 0) + n * a
    assert placed == counts
    return sum(n for _, n in got)


def check_covering(counts, capacity, gap):
    """Every length is covered, and the total is within the gap of a bound that holds: its prices never value a sequence over 1."""
    covering, covered = packing.configuration_lp(counts, capacity), {}
    for config, v in covering.x.items():
        assert v > 0 and sum(s * a for s, a in config) <= capacity
        for s, a in config:
            covered[s] = covered.get(s, 0) + v * a
    assert all(covered[s] >= n * (1 - 1e-9) for s, n in counts.items())
    total = sum(covering.x.values())
    assert sum(s * n for s, n in counts.items()) / capacity <= covering.bound * (1 + 1e-9) <= total * (1 + 1e-6) <= covering.bound * (1 + gap)


def test_plan_of_few_lengths():
    """Lengths from a seventh to two thirds of a sequence: no small pieces fill the gaps, and the program matters."""
    used, plain = 0, 0
    for seed in range(5):
        rnd, counts = random.Random(seed), {}
        while len(counts) < 40:
            counts[rnd.randint(300, 1300)] = rnd.randint(20, 120)
        check_covering(counts, 2048, 0.05)  # prices near the lengths bound it less closely here
        own, other = check_plan(counts, 2048), packing.best_fit(counts, 2048).total()
        assert own <= 1.005 * other
        used, plain = used + own, plain + other
    assert used < plain


@pytest.mark.parametrize("sf_name", ["sf0.01", "sf0.1"])
def test_plan_of_the_documents_lengths(sf_name):
    texts = pq.read_table(f"/root/testdata/{sf_name}/documents.parquet", columns=["text"]).column("text").combine_chunks()
    word, counts = tokens.tokenizer(WORD), {}
    texts = clean_texts(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts)
    for i, j in slices(texts):
        for n in (tokens.encode_slice(word, texts.slice(i, j - i))[1][1:] - tokens.encode_slice(word, texts.slice(i, j - i))[1][:-1] + 1).tolist():
            for length in [2048] * (n // 2048) + [n % 2048]:
                counts[length] = counts.get(length, 0) + 1
    counts.pop(0, None)
    check_covering({s: n for s, n in counts.items() if s < 2048}, 2048, 0.02)
    used = check_plan(counts, 2048)
    assert used <= packing.best_fit(counts, 2048).total() and used <= sum(s * n for s, n in counts.items()) / 2048 + 1.5


def test_small_plans():
    assert packing.plan({}, 100) == []
    assert check_plan({100: 7}, 100) == 7 and check_plan({1: 3}, 100) == 1 and check_plan({51: 4}, 100) == 4
    assert check_plan({60: 10, 50: 20, 40: 10, 30: 20, 20: 30}, 100) <= 33
    rnd = random.Random(4)
    for _ in range(20):
        check_plan({rnd.randint(1, 64): rnd.randint(1, 9) for _ in range(rnd.randint(1, 12))}, 64)
    with pytest.raises(ValueError, match="capacity"):
        packing.plan({101: 1}, 100)


def test_columns_with_names_of_its_own_are_replaced(spark):
    rows = spark.createDataFrame([(i, 1 + i % 7, 5, 6, 7, 8) for i in range(50)], "id int, length int, sequence_id int, offset int, rank int, `group` int")
    got = packing.pack(rows, 10).collect()
    assert rows.columns[:2] + ["rank", "group", "sequence_id", "offset"] == got[0].__fields__ and len(got) == 50
    for s in {r.sequence_id for r in got}:
        own = sorted((r.offset, r.length) for r in got if r.sequence_id == s)
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0 and sum(own[-1]) <= 10


def test_orc_of_rows_that_share_an_id(spark):
    """Starts follow the rows of the files, whatever the texts' checksums."""
    rnd = random.Random(7)
    rows = [(rnd.choice([1, 2, 2, 5]), "word " * rnd.randint(0, 9) + str(i)) for i in range(60)] + [(3, "same"), (3, "same"), (None, "no id")]
    path = work_path(spark, "tokens")
    token_orc.write_token_orc(frame(spark, rows), path, WORD, 1, files=3)
    ids = [x for f in sorted(glob.glob(f"{path.removeprefix('file:')}/*.orc")) for own in orc.read_table(f).column("ids").to_pylist() for x in own]
    got = sorted(map(tuple, token_orc.token_offsets(spark, path).collect()), key=lambda r: r[1])
    at = 0
    for _, start, n, own in got:
        assert start == at and own == crc(ids[at : at + n])
        at += n
    assert at == len(ids) and [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert sorted((str(r[0]), r[3]) for r in got) == sorted((str(i), crc(encoded(t, 1))) for i, t in rows)


def test_orc_keeps_statistics_that_skip_rows(spark):
    """Stripes carry the ids' smallest and largest value: a search for few ids reads few rows."""
    path = work_path(spark, "tokens")
    token_orc.write_token_orc(frame(spark, [(i, "a b c") for i in range(5000)]), path, WORD, 1, files=1)
    (name,) = glob.glob(f"{path.removeprefix('file:')}/*.orc")
    f = orc.ORCFile(name)
    assert f.nrows == 5000 and f.row_index_stride == token_orc.INDEX_STRIDE and f.compression == "ZSTD"
    raw = open(name, "rb").read()
    assert f.file_footer_length and f.stripe_statistics_length and len(raw) > f.content_length
    assert sorted(r.doc_id for r in token_orc.read_token_orc(spark, path, [7, 4999, 5001]).collect()) == [7, 4999]


@pytest.mark.parametrize("seed", range(3))
def test_added_tokens_in_another_case_are_ordinary_text(seed):
    rnd = random.Random(seed)
    odd = [*ODD, "<|EndOfText|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|startoftext|>", "Word", "word.", "X,"]
    texts = ["<|EndOfText|>", "ab<|ENDOFTEXT|>Cd.", "<|EndOfText|><|endoftext|>", "Ab<|endoftext|>CD."] + ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 10))) for _ in range(400)]
    word = tokens.tokenizer(WORD)
    ids, starts = tokens.encode_slice(word, pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == word.inner.encode(t, add_special_tokens=False).ids, t

"""Tokenizer encoding inside Arrow tasks, and token counts.

Encoding is done by distinct word. A batch is cut into slices of a few MB; Arrow splits a slice at white
space and numbers its distinct words; only words that a worker has not met yet go to the tokenizer, in one
call; a memory of bounded size keeps words met lately. That is exact where no token and no rule of the tokenizer reaches over the boundary used:

* ``.json`` word tokenizers whose pre-tokenizer drops white space: every ASCII white-space character is a
  boundary. A word is further cut before ASCII punctuation at its end that follows a letter. Words of Latin letters
  are lower-cased first if the normalizer does so. Words that hold an added token in any case go to the library as they are.
* ``.model`` sentencepiece models with escaped white space, a dummy prefix, no normalisation and no piece with
  the space sign after another character: each space that follows a character other than a space or the space
  sign itself is a boundary, and the dummy prefix of the next part stands for it.

Both conditions are checked when a tokenizer is loaded; one that fails them is given whole texts.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Memory, arrow_task, clean_texts, kept_objects, slices

#: Words that each half of a memory keeps (some 12 MB), and bytes of text encoded at a time.
KEPT_WORDS, ENCODED_BYTES = 80_000, 4 << 20
#: A word with ASCII punctuation at its end that follows a Latin letter; no apostrophes, which may belong to a contraction.
TAILED = r"(?s)^(?P<core>.*[A-Za-zÀ-ÖØ-öø-įı-ɏ])(?P<tail>[!-&(-/:-@\[-`{-~]+)$"
#: Characters other than those whose lower case is the same whatever stands around them.
NOT_LATIN = r"[^\x{0}-\x{12F}\x{131}-\x{24F}]"
SPACE_SIGN = "▁"


class WordTokenizer:
    """A ``tokenizers`` file; ``ids`` gives the little-endian unsigned 32-bit ids of words as bytes."""

    def __init__(self, path: str):
        import json

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ends = self._word_end_ids(spec)
        self.by_word = self.ends is not None
        rules = spec.get("normalizer") or {}
        self.lowers = any(r.get("type") == "Lowercase" for r in rules.get("normalizers") or [rules])
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.kept = Memory(KEPT_WORDS)

    @staticmethod
    def _word_end_ids(spec: dict) -> np.ndarray | None:
        """Which ids end a pre-token, if the file drops white space and marks word ends; else None."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        first = steps[0] if steps else {}
        dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "\\s" in str(first.get("pattern"))
        suffix, joined = spec["model"].get("end_of_word_suffix"), any(len(re.findall(r"\s", t["content"])) for t in spec.get("added_tokens", []))
        if not dropped or not suffix or joined or any(t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            return None
        vocabulary = spec["model"]["vocab"]
        ends = np.zeros(max(vocabulary.values()) + 1 + len(spec.get("added_tokens", [])), bool)
        for piece, number in vocabulary.items():
            ends[number] = piece.endswith(suffix)
        return ends

    def _one(self, text: str) -> bytes:
        return np.array(self.inner.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, words: list[str]) -> list[bytes]:
        """Plain words are encoded many to a text and cut at the word ends; the rest one by one."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if w.isalpha()]
        for i in range(0, len(plain), 512):
            part = plain[i : i + 512]
            ids = np.array(self.inner.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) == len(part):
                raw, before = ids.tobytes(), 0
                for w, end in zip(part, at.tolist(), strict=True):
                    out[w] = raw[4 * before : 4 * end]
                    before = end
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self.whole(rest), strict=True))
        return [out[w] for w in words]

    def _cut(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Words in lower case, and their punctuation at the end, which is encoded apart."""
        special = pa.array(np.zeros(len(words), bool))
        for token in self.added:
            special = pc.or_(special, pc.match_substring(words, token, ignore_case=True))
        low = pc.if_else(pc.match_substring_regex(words, NOT_LATIN), words, pc.utf8_lower(words)) if self.lowers else words
        parts = pc.extract_regex(low, TAILED)
        cut = pc.and_(parts.is_valid(), pc.invert(special))
        return pc.if_else(cut, parts.field("core"), pc.if_else(special, words, low)), pc.if_else(cut, parts.field("tail"), "")

    def words(self, words: pa.Array, times: np.ndarray) -> list[bytes]:
        """Ids of distinct words, given how often each occurs here."""
        cores, tails = (x.dictionary_encode() for x in self._cut(words))
        own, which = cores.dictionary.to_numpy(zero_copy_only=False).tolist(), cores.indices.to_numpy()
        known = self.kept.all(own)
        new = [i for i, ids in enumerate(known) if ids is None]
        seen = np.bincount(which, times, len(own))
        for i, ids in zip(new, self._encode_new([own[i] for i in new]), strict=True):
            known[i] = ids
            if seen[i] > 1:
                self.kept.put(own[i], ids)
        ends = [self._one(t) if t else b"" for t in tails.dictionary.to_pylist()]
        return [known[c] + ends[t] for c, t in zip(which.tolist(), tails.indices.to_numpy().tolist(), strict=True)]

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        parts = pc.ascii_split_whitespace(texts)
        return parts.offsets.to_numpy(), parts.flatten()


class PieceTokenizer:
    """A sentencepiece model; ``counts`` gives numbers of pieces."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.inner = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        self.by_word = bool(rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap and not any(SPACE_SIGN in p.piece.lstrip(SPACE_SIGN) or p.type == 4 for p in model.pieces))
        self.kept = Memory(KEPT_WORDS)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.inner.encode(texts, num_threads=1)]

    def words(self, words: list[str], times: np.ndarray) -> list[int]:
        found = self.kept.all(words)
        missing = [i for i, x in enumerate(found) if x is None]
        for i, n in zip(missing, self.whole([words[i] for i in missing]) if missing else [], strict=True):
            # An empty part only stands for a space at the end of a text (or an empty text: see count_slice).
            found[i] = n or 1
            if times[i] > 1:
                self.kept.put(words[i], found[i])
        return found

    def split_text(self, text: str) -> list[str]:
        """Cut at every space that follows a character other than a space or the space sign."""
        return re.split(rf"(?<=[^ {SPACE_SIGN}]) ", text)


def tokenizer(path: str):
    """The tokenizer of a file, loaded once a worker; a worker keeps one at a time."""
    if path not in kept_objects:
        kept_objects.clear()
        kept_objects[path] = PieceTokenizer(path) if path.endswith(".model") else WordTokenizer(path)
    return kept_objects[path]


def encode_slice(tok: WordTokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, one after the other, and where each text's ids start (with the end)."""
    if not tok.by_word:
        parts = tok.whole(texts.to_pylist())
        return np.frombuffer(b"".join(parts), "<u4"), np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)])
    offsets, values = tok.split(texts)
    coded = values.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    known = tok.words(coded.dictionary, np.bincount(which, minlength=len(coded.dictionary)))
    size = np.fromiter(map(len, known), np.int64, len(known)) // 4
    flat = np.frombuffer(b"".join(known), "<u4")
    first = np.concatenate([[0], np.cumsum(size)])[:-1] if len(size) else size
    n = size[which]
    ends = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.repeat(first[which] - ends[:-1], n) + np.arange(ends[-1])] if len(which) else flat[:0]
    return ids, ends[offsets - offsets[0]]


def count_slice(tok, texts: pa.Array) -> np.ndarray:
    if isinstance(tok, WordTokenizer):
        return np.diff(encode_slice(tok, texts)[1])
    if not tok.by_word:
        return np.array(tok.whole(texts.to_pylist()), np.int64)
    plain = pc.invert(pc.match_substring_regex(texts, f"  |^ |{SPACE_SIGN}"))
    out = np.zeros(len(texts), np.int64)
    at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
    if len(at):
        parts = pc.split_pattern(texts.take(pa.array(at)), " ")
        coded = parts.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        n = np.array(tok.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.bincount(which, minlength=len(coded.dictionary))), np.int64)
        total = np.concatenate([[0], np.cumsum(n[which])])
        offsets = parts.offsets.to_numpy()
        out[at] = np.diff(total[offsets - offsets[0]])
    for i in np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist():
        own = Counter(tok.split_text(texts[i].as_py()))
        out[i] = sum(n * k for n, k in zip(tok.words(list(own), list(own.values())), own.values(), strict=True))
    out[np.asarray(pc.binary_length(texts)) == 0] = 0
    return out


def _counter(path: str, keys: list[str]) -> Callable:
    def count(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            n = [count_slice(tok, texts.slice(i, j - i)) for i, j in slices(texts, ENCODED_BYTES)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pc.binary_length(texts).cast(pa.int64()), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())], names=[*keys, "n_bytes", "n_tokens"])

    return arrow_task(count, keep=True)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: ``id_col, n_bytes, n_tokens, over_limit``.

    Only lengths leave the Arrow function. Null texts count as empty (0 bytes, 0 tokens, not over the limit);
    null ids and repeated rows are kept, one row each; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    out = rows.mapInArrow(_counter(tokenizer_path, ["__id"]), f"__id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("__id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit"))


def _piece_encoder(path: str, end_id: int, most: int | None, keep_ids: bool, keys: list[str]) -> Callable:
    tail = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = clean_texts(batch.column("__text"))
            for i, j in slices(texts, ENCODED_BYTES):
                ids, starts = encode_slice(tok, texts.slice(i, j - i))
                raw = memoryview(np.ascontiguousarray(ids)).cast("B")
                row, piece, start, length, crc, data = [], [], [], [], [], []
                for k in range(j - i):
                    a, b = int(starts[k]), int(starts[k + 1])
                    own = bytes(raw[4 * a : 4 * b]) + tail
                    n = b - a + 1
                    step = most or n
                    for p, at in enumerate(range(0, n, step)):
                        part = own[4 * at : 4 * (at + step)] if n > step else own
                        row.append(i + k)
                        piece.append(p)
                        start.append(at)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            data.append(part)
                at = pa.array(row, pa.int64())
                columns = [pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
                names = ["piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array(data, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), *columns], names=[*keys, *names])

    return arrow_task(encode, keep=True)


def encode_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Ids of every whole text, then ``end_id``, cut into pieces of at most ``max_tokens`` ids (None: uncut).

    Returns ``id_col, piece, start, length, ids_crc32`` and, with ``keep_ids``, ``ids``: little-endian unsigned 32-bit ids. A
    null or empty text is one piece with the end id alone. Repeated rows and null ids give rows of their own.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    columns = f"__id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return rows.mapInArrow(_piece_encoder(tokenizer_path, end_id, max_tokens, keep_ids, ["__id"]), columns).withColumnRenamed("__id", id_col)

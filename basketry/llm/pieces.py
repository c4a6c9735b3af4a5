"""SentencePiece encoding and decoding by a table of last tokens.

Merge-type (BPE) pieces: neighbouring symbols whose concatenation is a piece are merged, best
score first, leftmost among equals. Every prefix of a text has one encoding, hence one last
token. An encoding is right exactly when each two neighbours in it are: when merging their
characters gives the two again. So the last token of a prefix is the one match of the
automaton of pieces that ends there and is compatible with the last token of the prefix
before it. The table is filled from left to right, and ids are read off it backwards: linear
in the text, whatever its words look like.

Characters that no piece has become one id per byte of their UTF-8 form. Texts are cut where
no piece can span the cut: before a run of blanks, and at control characters of no piece.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.tasks import map_arrow, table, texts_of

SPACE = "▁"  # stands for a blank inside pieces
UNKNOWN = " ⁇ "  # what the unknown id reads as
CACHED = 1 << 18  # segments whose ids a task remembers, besides as many older ones
CACHED_CHARS = 48  # longer ones are not remembered
CHARS = 1 << 20  # characters whose ids a task hands over at once


@dataclass(frozen=True)
class PieceModel:
    """What a model file says: ``pieces`` that merge with ``scores``, ``first`` of the 256
    byte ids, ids without a text of their own, and whether a blank is put in front."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]
    control: frozenset[int]
    unknown: int
    prefix: bool
    size: int

    @classmethod
    def parse(cls, content: bytes) -> PieceModel:
        """From the bytes of a model file; what the method does not cover is an error."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto.FromString(content)
        kinds = proto.ModelProto.SentencePiece
        text, trained = model.normalizer_spec, model.trainer_spec
        wrong = [
            name
            for name, found in (
                ("not a merge-type model", trained.model_type != proto.TrainerSpec.BPE),
                ("no byte pieces", not trained.byte_fallback),
                ("blanks as suffix", trained.treat_whitespace_as_suffix),
                ("a normalisation table", bool(text.precompiled_charsmap)),
                ("blanks removed", text.remove_extra_whitespaces),
                ("blanks not escaped", not text.escape_whitespaces),
                ("characters of pieces that are no pieces", not {c for p in model.pieces if p.type == kinds.NORMAL for c in p.piece} <= {p.piece for p in model.pieces}),
                ("user-defined or unused pieces", any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)),
            )
            if found
        ]
        if wrong:
            raise ValueError(f"unsupported model: {', '.join(wrong)}")
        of_kind = lambda kind: [i for i, p in enumerate(model.pieces) if p.type == kind]
        normal = of_kind(kinds.NORMAL)
        byte_ids = {int(model.pieces[i].piece[3:5], 16): i for i in of_kind(kinds.BYTE)}
        return cls(
            ids={model.pieces[i].piece: i for i in normal},
            scores={model.pieces[i].piece: model.pieces[i].score for i in normal},
            byte_ids=tuple(byte_ids[b] for b in range(256)),
            control=frozenset(of_kind(kinds.CONTROL)),
            unknown=trained.unk_id,
            prefix=text.add_dummy_prefix,
            size=len(model.pieces),
        )

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> PieceModel:
        """From a file of the driver or, given with a scheme, of any store Spark reads."""
        if "://" in path:
            return cls.parse(bytes(spark.read.format("binaryFile").load(path).first()["content"]))
        with open(path, "rb") as file:
            return cls.parse(file.read())


def _best(symbols: list[str], scores: dict[str, float]) -> tuple[int, float] | None:
    """Place and score of the best neighbours to merge, the leftmost among equals."""
    best, at = None, 0
    for i in range(len(symbols) - 1):
        score = scores.get(symbols[i] + symbols[i + 1])
        if score is not None and (best is None or score > best):
            best, at = score, i
    return None if best is None else (at, best)


def merged(symbols: list[str], scores: dict[str, float]) -> list[str]:
    """The definition: merge the best neighbours, leftmost first, until none concatenate."""
    symbols = list(symbols)
    while (step := _best(symbols, scores)) is not None:
        at = step[0]
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


_NEVER = float("-inf")


@dataclass(frozen=True)
class _Edges:
    """``whole``: the token's characters merge to the token. ``first``, ``last``: symbols
    that stand at its ends in turn, each with the score of the merge that consumes it.
    ``falling``: its merges come in strictly falling order of score."""

    whole: bool
    falling: bool
    first: list[tuple[str, float]]
    last: list[tuple[str, float]]

    @classmethod
    def of(cls, token: str, scores: dict[str, float]) -> _Edges:
        first, last, used = [], [], []
        symbols = list(token)
        while (step := _best(symbols, scores)) is not None:
            at, score = step
            if at == 0:
                first.append((symbols[0], score))
            if at == len(symbols) - 2:
                last.append((symbols[-1], score))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            used.append(score)
        first.append((symbols[0], _NEVER))
        last.append((symbols[-1], _NEVER))
        falling = all(a > b for a, b in zip(used, used[1:]))
        return cls(len(symbols) == 1, falling, first, last)


_FREE = -1  # stands before a text, and where a character of no piece ends


class Encoder:
    """Encodes and decodes with one model; made once in each task.

    A match of the automaton carries the size of its token and, by the id of the token before
    it, its id where the two are compatible, else ``_FREE``, as far as that was asked.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.token = dict(zip(model.ids.values(), model.ids))
        self.size = [0] * model.size
        self.mark = next(c for c in map(chr, range(0x110000)) if c not in model.ids)
        self.automaton = ahocorasick.Automaton()
        self.automaton.add_word(self.mark, (0, {}))
        for piece, number in model.ids.items():
            self.size[number] = len(piece)
            self.automaton.add_word(piece, (len(piece), {}))
        self.automaton.make_automaton()
        inner = [p for p in model.ids if len(p) > 1]
        self.pairs = {p[i : i + 2] for p in inner for i in range(len(p) - 1)}
        self.grown: dict[str, _Edges] = {}
        self.segments: dict[str, bytes] = {}  # ids of remembered segments, four bytes each
        self.older: dict[str, bytes] = {}  # those before them; what is met again moves up
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in inner))
        if any(SPACE in p.lstrip(SPACE) for p in inner):  # a piece spans the start of a word
            self.cut = re.compile("(?s).+")
        else:
            own = f"|[{alone}]" if alone else ""
            self.cut = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+{own}")
        self.surface = [b""] * model.size
        for piece, number in model.ids.items():
            self.surface[number] = piece.replace(SPACE, " ").encode()
        for byte, number in enumerate(model.byte_ids):
            self.surface[number] = bytes([byte])
        self.surface[model.unknown] = UNKNOWN.encode()
        self.control = np.zeros(model.size, dtype=bool)
        self.control[list(model.control)] = True
        self.starts = {i for p, i in model.ids.items() if p.startswith(SPACE)}

    def edges(self, token: str) -> _Edges:
        """How the first and the last symbol of a token grow while it is merged alone."""
        found = self.grown.get(token)
        if found is None:
            found = self.grown[token] = _Edges.of(token, self.model.scores)
        return found

    def compatible(self, before: str, token: str) -> bool:
        """Whether ``token`` may follow ``before`` (empty: stand first)."""
        return self.edges(token).whole and (not before or self._apart(before, token))

    def _apart(self, before: str, token: str) -> bool:
        """Whether merging both together never joins symbols over their boundary.

        The symbols that touch there are followed in the order of the merges that consume
        them: best scores come first. Where scores tie, or a token's own merges do not come
        in falling order, the two are merged as the definition says.
        """
        if before[-1] + token[0] not in self.pairs:
            return True
        left, right, scores = self.edges(before), self.edges(token), self.model.scores
        if not (left.falling and right.falling):
            return merged(list(before + token), scores) == [before, token]
        a = b = 0
        while True:
            (x, x_end), (y, y_end) = left.last[a], right.first[b]
            over, end = scores.get(x + y), max(x_end, y_end)
            if over is not None and over > end:
                return False
            if over == end or (x_end == y_end and end > _NEVER):
                return merged(list(before + token), scores) == [before, token]
            if end == _NEVER:
                return True
            if x_end > y_end:
                a += 1
            else:
                b += 1

    def last_tokens(self, texts: list[str]) -> list[int] | array:
        """For each prefix of each of ``texts``, which stand in ascending order, the id of its
        last token; ``_FREE`` where that is a character of no piece.

        The table covers the texts joined by the mark: entry i is for the prefix that ends with
        character i. What a text shares with the one before it is taken over from there.
        """
        whole = self.mark.join(texts)
        none = [_FREE] if len(whole) <= CHARS else array("i", [_FREE])
        last = none * (len(whole) + 1)  # the entry behind the last one is that of nothing at all
        following, begin = 0, 0
        for end, (size, fits) in self.automaton.iter(whole):
            if last[end] < 0:
                before = last[end - size]
                found = fits.get(before)
                if found is None:
                    if not size:  # the mark, or a character like it
                        if end != begin + len(texts[following]):
                            continue
                        shared = _shared(texts[following], texts[following + 1])
                        last[end + 1 : end + 1 + shared] = last[begin : begin + shared]
                        begin, following = end + 1, following + 1
                        continue
                    number = self.model.ids[whole[end - size + 1 : end + 1]]
                    fits_here = self.compatible(self.token.get(before, ""), self.token[number])
                    found = fits[before] = number if fits_here else _FREE
                last[end] = found
        return last

    def _learn(self, texts: list[str]) -> None:
        """Ids of some segments, by one table of all of them."""
        last, size, ids = self.last_tokens(texts), self.size, self.model.ids
        begin = 0
        for text in texts:
            end, found = begin + len(text), []
            while end > begin:
                number = last[end - 1]
                if number >= 0:
                    found.append(number)
                    end -= size[number]
                    continue
                end -= 1
                char = text[end - begin]
                if char in ids:
                    raise ValueError(f"no last token of {text[: end + 1 - begin]!r}: merges without an order")
                found.extend(self.model.byte_ids[b] for b in reversed(char.encode()))
            found.reverse()
            self.segments[text] = array("i", found).tobytes()
            begin += len(text) + 1

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without begin or end ids, as 32-bit numbers."""
        prefix = SPACE if self.model.prefix else ""
        parts = [self.cut.findall(prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.segments) > CACHED:
            self.older, self.segments = self.segments, {}
        needed = set(chain.from_iterable(parts)).difference(self.segments)
        self.segments.update((t, self.older[t]) for t in needed if t in self.older)
        unknown = sorted(needed.difference(self.segments))
        for low, high in _runs([len(t) for t in unknown], CHARS):
            self._learn(unknown[low:high])
        found = [b"".join(map(self.segments.__getitem__, part)) for part in parts]
        for text in unknown:
            if len(text) > CACHED_CHARS:
                del self.segments[text]
        return found

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Text of ids: bytes that are no UTF-8 read as U+FFFD each, one leading blank goes."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ""
        if ids.min() < 0:
            raise ValueError(f"no id of the model: {ids.min()}")
        control = self.control[ids]
        parts = [ids]
        if control.any():  # they say nothing, but end a run of bytes
            parts = [p[1:] if self.control[p[0]] else p for p in np.split(ids, np.flatnonzero(control)) if len(p)]
            parts = [p for p in parts if len(p)]
        contents = [b"".join(map(self.surface.__getitem__, part.tolist())) for part in parts]
        if parts and self.model.prefix and int(parts[0][0]) in self.starts:
            contents[0] = contents[0][1:]
        return "".join(map(_text, contents))


def _text(content: bytes) -> str:
    try:
        return content.decode()
    except UnicodeDecodeError:
        codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
        return content.decode(errors="each_byte")


def _shared(a: str, b: str) -> int:
    """Number of characters that both begin with."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def _runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of ``most`` units together; a larger row is a range of its own."""
    low = total = 0
    for i, size in enumerate(sizes):
        if i > low and total + size > most:
            yield low, i
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def encode_texts(docs: DataFrame, model: PieceModel) -> DataFrame:
    """``doc_id``, ``ids`` of every text, a row each.

    A null or empty text has no ids. Bytes that are no UTF-8 count as U+FFFD. Texts of any
    length are encoded whole; repeated rows stay; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = Encoder(model)
        for batch in batches:
            texts = [t.decode(errors="replace") for t in texts_of(batch)]
            for low, high in _runs([len(t) for t in texts], CHARS):
                parts = encoder.encode_all(texts[low:high])
                ends = np.cumsum([0, *map(len, parts)]) // 4
                yield {
                    "doc_id": batch.column("doc_id")[low:high],
                    "ids": pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), np.int32))
                    ),
                }

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, ids array<int>", run)


def decode_ids(rows: DataFrame, model: PieceModel) -> DataFrame:
    """``doc_id``, ``ids``, ``decoded``: the text of each row's ids, empty without ids.

    Ids are those of the model; another one, a null among them, is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = Encoder(model)
        for batch in batches:
            lists = batch.column("ids")
            if lists.flatten().null_count:
                raise ValueError("a null is no id of the model")
            sizes = [n or 0 for n in lists.value_lengths().to_pylist()]
            for low, high in _runs(sizes, CHARS):
                part = lists[low:high]
                ids = np.split(part.flatten().to_numpy(), np.cumsum(sizes[low:high])[:-1])
                yield {
                    "doc_id": batch.column("doc_id")[low:high],
                    "ids": part,
                    "decoded": [encoder.decode(one) for one in ids],
                }

    return map_arrow(rows.select("doc_id", "ids"), "doc_id long, ids array<int>, decoded string", run)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op13_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Counts and digests of the ids of every document and of the text they decode to."""
    model = PieceModel.read(spark, path or vocabulary("piece_bpe_32k.model"))
    read = decode_ids(encode_texts(table(spark, sf_dir, "documents"), model), model)
    return read.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

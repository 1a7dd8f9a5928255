"""Packing documents into sequences of a fixed number of tokens.

First-fit decreasing, run on its own in groups of documents drawn at random.
The open sequences of a group sit at the leaves of a tournament tree whose
inner nodes hold the largest free space below them: the first sequence with
room for a piece is found in log(sequences) steps.

A document longer than a sequence is cut: its full parts are sequences of
their own, its last part is packed like a short document.

Defined results: a null or empty text is its end token alone; repeated rows
are packed once each; a null id stays null; an empty table gives no rows;
columns other than the id and the text are ignored. Texts are read whole,
whatever their length.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Documents and bytes of text in a group, on average. A group is packed in one call.
GROUP_DOCS, GROUP_BYTES = 2048, 8 << 20
#: Words whose ids a worker remembers before it starts afresh; as many pieces of other words.
REMEMBERED = 400_000
#: Fixed value: how a byte-level pre-tokenizer cuts a text.
PIECES_OF_TEXT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEED = 20240607
ID = attrgetter("id")

PIECES = "doc_id long, start long, length long, {ids}, doc_tokens long, sequence_id long, offset long"


class TournamentTree:
    """Free space of the sequences of a group, in the order in which they were opened.

    All leaves start out as unopened sequences, so a piece always finds room.
    """

    def __init__(self, sequences: int, capacity: int) -> None:
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """The first sequence with room for ``length`` tokens; the room is taken."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        found, free[node] = node - self.leaves, free[node] - length
        while node > 1:
            node //= 2
            winner = max(free[2 * node], free[2 * node + 1])
            if free[node] == winner:
                break
            free[node] = winner
        return found


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The sequence of each piece; longer pieces first, equal ones in the given order."""
    tree, found = TournamentTree(len(lengths), capacity), [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found[k] = tree.place(lengths[k])
    return found


class PieceIds(dict):
    """Ids, as little-endian 32-bit numbers, of one piece that the pre-tokenizer makes."""

    def __init__(self, model) -> None:
        super().__init__()
        self.tokenize = model.tokenize
        # Bytes that print stand for themselves, the others for characters from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        spare = iter(range(256, 512))
        self.letters = {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = ids = self.of_spelled(piece.encode().decode("latin-1").translate(self.letters))
        return ids

    def of_spelled(self, spelled: str) -> bytes:
        return array("I", map(ID, self.tokenize(spelled))).tobytes()


class SpacesMeet(Exception):
    """White space stands beside white space, so a text is not the sum of its words."""


class WordIds(dict):
    """The same of a space with the word after it.

    The pre-tokenizer never joins what stands before a space to what stands
    after it, so a text without two white space characters in a row has the ids
    of its words, one after the other. Other texts are encoded in one go.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if not isinstance(self.tokenizer.pre_tokenizer, ByteLevel) or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} is not a byte-level tokenizer")
        model = self.tokenizer.model
        model._resize_cache(0)  # its own memory of words costs more than it saves
        self.pieces, self.split = PieceIds(model), regex.compile(PIECES_OF_TEXT).findall
        self.space = self.pieces.letters[0x20]
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.at_space = regex.compile(r"^\s|\s\s|\s$|^$").search

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if word.isalpha():
            # A piece of its own with the space before it, which is spelled as the letter of byte 32.
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.pieces.letters)
            ids = self.pieces.of_spelled(self.space + spelled)
        elif word and word[-1] in ".,;:!?" and word[:-1].isalpha():
            ids = self[word[:-1]] + self.pieces[word[-1]]
        elif self.at_space(word):
            raise SpacesMeet
        else:
            ids = b"".join(map(self.pieces.__getitem__, self.split(" " + word)))
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if self.at_space(first) or any(s in text for s in self.specials):
            return self.encode(text)
        try:
            return self.encode(first) + b"".join(map(self.__getitem__, rest))
        except SpacesMeet:
            return self.encode(text)


_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each worker and tokenizer; tasks that follow find the words of those before."""
    if path not in _ids:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ids[path] = WordIds(path)
    return _ids[path]


def pieces_of(ids: bytes, sequence: int) -> Iterator[tuple[int, bytes]]:
    for start in range(0, len(ids) // 4, sequence):
        yield start, ids[4 * start : 4 * (start + sequence)]


def pack(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it stands in its document and its sequence, and its ids.

    ``tokenizer`` is the path of a byte-level tokenizer file that every
    executor has. ``ids`` are little-endian unsigned 32-bit numbers; without
    them their crc32 stands in their place, as ``ids_crc32``.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-n // GROUP_DOCS), -(-size // GROUP_BYTES))
    # The row's place makes rows of one id fall into different groups; it is the same when a task is run again.
    group = F.pmod(F.xxhash64(F.lit(SEED), F.monotonically_increasing_id()), F.lit(groups))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        known, end = word_ids(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        table = table.sort_by([("doc_id", "ascending"), ("place", "ascending")])
        out = []
        for doc_id, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True):
            ids = known.of(text) + end
            out += [(doc_id, start, part, len(ids) // 4) for start, part in pieces_of(ids, sequence)]
        lengths = [len(part) // 4 for _, _, part, _ in out]
        places = first_fit_decreasing(lengths, sequence)
        filled: dict[int, int] = {}
        offsets = [0] * len(out)
        for k in sorted(range(len(out)), key=lambda k: -lengths[k]):
            offsets[k] = filled.get(places[k], 0)
            filled[places[k]] = offsets[k] + lengths[k]
        first = key[0].as_py() << 32
        return pa.table(
            {
                "doc_id": pa.array([o[0] for o in out], pa.int64()),
                "start": pa.array([o[1] for o in out], pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                **(
                    {"ids": pa.array([o[2] for o in out], pa.binary())}
                    if with_ids
                    else {"ids_crc32": pa.array([zlib.crc32(o[2]) for o in out], pa.int64())}
                ),
                "doc_tokens": pa.array([o[3] for o in out], pa.int64()),
                "sequence_id": pa.array([first + p for p in places], pa.int64()),
                "offset": pa.array(offsets, pa.int64()),
            }
        )

    grouped = rows.select("doc_id", "text", F.monotonically_increasing_id().alias("place"), group.alias("grp"))
    schema = PIECES.format(ids="ids binary" if with_ids else "ids_crc32 long")
    return grouped.groupBy("grp").applyInArrow(packed, schema)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of all documents with a checksum in place of their ids."""
    return pack(docs, tokenizer, with_ids=False)

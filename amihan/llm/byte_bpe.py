"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

The last token of the encoding of a prefix fixes the rest of that encoding,
so encoding is a walk over prefixes.  Vocabulary entries that may end at a
position are read off an automaton: the entries started at every position at
once, determinised - a state is the longest suffix that some entry begins
with - and made only where a text first leads.  Of the entries ending at a
position the last token is the longest that forms a stable pair with the last
token of the prefix before it: one that no merge ever crosses, found from the
merges at the two edges.  A token is given out when all positions that an
entry under way started from agree on it, or at the end of the piece; entries
have a bounded length, and so has the look-ahead.

Texts are split by the vocabulary's pattern first; results of short pieces
are kept in tables of bounded size, which change nothing but time.  A table
has two generations: a full young one becomes the old one, and what is found
in the old one moves up, so frequent entries are never lost.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.llm.common import by_row, give_back, map_arrow, worker_state

#: Bounds of the young tables of one worker; a dictionary doubles its room just beyond such numbers.
MAX_PAIRS = 174_000
MAX_PIECES = 174_000
MAX_UNITS = 349_000
MAX_HEADS = 87_000
#: Lengths of beginnings of pieces whose state is kept, the longer first.
HEADS = (8, 4)
#: Longer pieces and units are not kept.
KEPT_CHARS = 48
#: Pending bytes after which it is seen what can be given out.
LOOK_AHEAD = 1024
DECODE_TOKENS = 1 << 16
NEVER = 1 << 62


class Utf8Stream:
    """Bytes in, characters out as soon as they are whole; bytes that fit nowhere become U+FFFD."""

    #: Lowest lead byte and length of the sequences of UTF-8.
    LEADS = ((0xF0, 4), (0xE0, 3), (0xC0, 2))

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = next(n for lead, n in self.LEADS if byte >= lead)
                if back < need and self._may_go_on(data[-back:]):
                    cut -= back
                break
            if byte < 0x80:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    @staticmethod
    def _may_go_on(start: bytes) -> bool:
        """Whether some continuation makes the bytes one character."""
        try:
            start.decode("utf-8")
        except UnicodeDecodeError as e:
            return e.reason == "unexpected end of data"
        return False

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Transducer:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.names = {i: str(i) for i in self.token}
        self.begun = {t[:n] for t in ranks for n in range(1, len(t) + 1)}
        self.pattern = regex.compile(pattern)
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.spines: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self.stable: dict[int, bool] = {}
        #: The automaton: a state's bytes, and the (length, id) of entries ending there, longest first.
        self.suffix: list[bytes] = [b""]
        self.ending: list[tuple[tuple[int, int], ...]] = [()]
        self.arrows: dict[int, int] = {}
        self.state_of: dict[bytes, int] = {b"": 0}
        self.old_stable: dict[int, bool] = {}
        self.forget()
        self.gap = regex.compile(r" (?!\S)")
        self.cut = regex.compile(r" (?=\S)")

    def forget(self) -> None:
        """Empty the tables of texts; what is known of the vocabulary stays."""
        self.heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.old_heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}
        self.old_pieces: dict[str, tuple[int, ...]] = {}
        self.old_units: dict[str, tuple[int, ...]] = {}

    def _merged(self, data: bytes, below: int) -> list[bytes]:
        """Merge the lowest rank first while it is under a bound."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes a token; None for single bytes and for entries no merge makes."""
        if token not in self.parts:
            made = self._merged(token, self.ranks[token]) if len(token) > 1 else []
            self.parts[token] = (made[0], made[1]) if len(made) == 2 else None
        return self.parts[token]

    def _spine(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The pieces at a token's edge in the order they come about, each with the rank that ends it."""
        key = (token, right)
        if key not in self.spines:
            steps, ends = [(token, NEVER)], NEVER
            while halves := self._halves(token):
                ends = self.ranks[token]
                token = halves[1] if right else halves[0]
                steps.append((token, ends))
            self.spines[key] = steps[::-1]
        return self.spines[key]

    def _pair_holds(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the border of two neighbouring tokens."""
        a, b = self._spine(self.token[left], True), self._spine(self.token[right], False)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.ranks.get(x + y, NEVER)
            # At one rank the leftmost merge comes first: x with its left neighbour, then x with y.
            if rank < NEVER and rank < x_ends and rank <= y_ends:
                return False
            if x_ends <= y_ends and i + 1 < len(a):
                i += 1
            elif j + 1 < len(b):
                j += 1
            else:
                return True

    def _arrow(self, state: int, byte: int) -> int:
        """The state that a byte leads to, made on first need."""
        seen = self.suffix[state] + bytes((byte,))
        while seen not in self.begun:
            if len(seen) == 1:
                raise ValueError(f"the vocabulary lacks byte {byte}")
            seen = seen[1:]
        if seen not in self.state_of:
            ends = (seen[n:] for n in range(len(seen)))
            made = tuple((len(t), self.ranks[t]) for t in ends if t in self.ranks and (len(t) == 1 or self._halves(t)))
            self.state_of[seen] = len(self.suffix)
            self.suffix.append(seen)
            self.ending.append(made)
        self.arrows[state << 8 | byte] = self.state_of[seen]
        return self.state_of[seen]

    def _path(self, last: list[int], end: int) -> list[int]:
        path = []
        while end > 0:
            path.append(last[end - 1])
            end -= len(self.token[path[-1]])
        return path[::-1]

    def _agreed(self, last: list[int], state: int) -> list[int]:
        """The tokens on the paths of all positions that an entry under way started from."""
        n, under_way = len(last), self.suffix[state]
        starts = [n] + [n - len(under_way) + k for k in range(len(under_way)) if under_way[k:] in self.begun]
        paths = [self._path(last, p) for p in starts if p == 0 or last[p - 1] >= 0]
        same = 0
        while all(len(p) > same for p in paths) and len({p[same] for p in paths}) == 1:
            same += 1
        return paths[0][:same]

    def walk(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        if piece in self.ranks:
            return (self.ranks[piece],)
        if len(self.stable) >= MAX_PAIRS:
            self.old_stable, self.stable = self.stable, {}
        if len(self.heads) >= MAX_HEADS:
            self.old_heads, self.heads = self.heads, {}
        arrows, ending, stable = self.arrows, self.ending, self.stable
        state = 0
        #: The last token of each prefix since what was given out; -1 where it begins before that.
        last: list[int] = []
        out: list[int] = []
        for length in HEADS:
            if len(piece) <= length:
                continue
            begin = piece[:length]
            head = self.heads.get(begin)
            if head is None and (head := self.old_heads.get(begin)):
                self.heads[begin] = head
            if head:
                state, last = head[0], [*head[1]]
                break
        known = len(last)
        for byte in piece[known:]:
            state = arrows.get(state << 8 | byte) or self._arrow(state, byte)
            end = len(last)
            for length, token in ending[state]:
                start = end - length
                if start < -1:
                    continue
                if start == -1:
                    prior = out[-1] if out else None
                else:
                    prior = last[start]
                    if prior < 0:
                        continue
                if prior is not None:
                    pair = prior << 20 | token
                    holds = stable.get(pair)
                    if holds is None:
                        holds = self.old_stable.get(pair)
                        stable[pair] = holds = self._pair_holds(prior, token) if holds is None else holds
                    if not holds:
                        continue
                last.append(token)
                break
            else:
                last.append(-1)
            if end + 1 in HEADS and not out:
                self.heads[piece[: end + 1]] = (state, tuple(last))
            if end + 1 >= LOOK_AHEAD:
                given = self._agreed(last, state)
                out += given
                gone = sum(len(self.token[t]) for t in given)
                last = [
                    t if t >= 0 and p + 1 - len(self.token[t]) >= gone else -1 for p, t in enumerate(last) if p >= gone
                ]
        return (*out, *self._path(last, len(last)))

    def _unit_ids(self, unit: str) -> tuple[int, ...]:
        """The ids of a unit that the young table lacks."""
        short = len(unit) <= KEPT_CHARS
        ids = self.old_units.get(unit) if short else None
        if ids is None:
            pieces = self.pattern.findall(unit)
            if len(pieces) == 1 and pieces[0] == unit:
                # One object serves as key and value of both tables.
                ids = self.pieces.get(unit) or self._piece_ids(unit)
            else:
                listed: list[int] = []
                for piece in pieces:
                    listed += self.pieces.get(piece) or self._piece_ids(piece)
                ids = tuple(listed)
        if short:
            if len(self.units) >= MAX_UNITS:
                self.old_units, self.units = self.units, {}
            self.units[unit] = ids
        return ids

    def _piece_ids(self, piece: str) -> tuple[int, ...]:
        """The ids of a piece that the young table lacks."""
        found = self.old_pieces.get(piece)
        if found is None:
            found = self.walk(piece.encode())
        if len(piece) <= KEPT_CHARS:
            if len(self.pieces) >= MAX_PIECES:
                self.old_pieces, self.pieces = self.pieces, {}
            self.pieces[piece] = found
        return found

    def encode(self, text: str) -> Iterator[tuple[int, ...]]:
        """The ids of a text in order, unit by unit.

        A unit starts at a space that something else than white space
        follows: the pattern always starts a match there, whatever is before.
        """
        units = text.split(" ") if self.gap.search(text) is None else self.cut.split(text)
        known, space = self.units.get, ""
        for unit in units:
            unit = space + unit
            found = known(unit)
            if found is None:
                found = self._unit_ids(unit)
                known = self.units.get
            yield found
            space = " "

    def decode(self, ids: Iterable[int]) -> Iterator[bytes]:
        """The bytes of ids, in blocks."""
        block: list[int] = []
        for i in ids:
            block.append(i)
            if len(block) == DECODE_TOKENS:
                yield b"".join(map(self.token.__getitem__, block))
                block.clear()
        yield b"".join(map(self.token.__getitem__, block))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def transducer(path: str, pattern: str) -> Transducer:
    return worker_state(("transducer", path, pattern), lambda: Transducer(read_ranks(path), pattern))


def _task_ends(path: str, pattern: str) -> Callable[[], None]:
    """Workers may idle while others work: the tables of a task's texts go when it ends."""

    def done() -> None:
        transducer(path, pattern).forget()
        give_back()

    return done


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text.

    A null or empty text has no ids; repeated rows and null document ids stay
    as rows; an empty table gives no rows; other columns take no part.  The
    vocabulary file must be at the same path on every executor, as an
    installed package is.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def rows(doc_id: int | None, text: str | None):
        coder = transducer(ranks_path, pattern)
        yield doc_id, [i for ids in coder.encode(text or "") for i in ids]

    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    run = by_row(rows, ("doc_id", "text"), schema, _task_ends(ranks_path, pattern))
    return map_arrow(asked, run, "doc_id bigint, ids array<int>")


def decode_ids(coded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that are no UTF-8 become U+FFFD.  Null ids are an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = transducer(ranks_path, pattern)
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                stream = Utf8Stream()
                text = "".join(map(stream.feed, coder.decode(ids.as_py() or ()))) + stream.close()
                yield pa.RecordBatch.from_pydict({"doc_id": [doc_id], "text": [text]}, schema=schema)

    return map_arrow(coded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def token_digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, valid_utf8) of encoding each text and decoding the ids again.

    Digests are of the decimal ids joined by one space, and of the decoded
    bytes.  The ids of a text go straight from the encoder to the decoder and
    the digests, block by block, so no token leaves its task.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("valid_utf8", pa.bool_())]
    )

    def rows(doc_id: int | None, text: str | None):
        coder = transducer(ranks_path, pattern)
        listed, decoded, stream = hashlib.sha256(), hashlib.sha256(), Utf8Stream()
        n, damaged, gap = 0, False, ""
        names, token = coder.names, coder.token
        block: list[int] = []

        def flush() -> None:
            nonlocal n, damaged, gap
            listed.update((gap + " ".join(map(names.__getitem__, block))).encode())
            data = b"".join(map(token.__getitem__, block))
            decoded.update(data)
            damaged |= "�" in stream.feed(data)
            n, gap = n + len(block), " "
            block.clear()

        for ids in coder.encode(text or ""):
            block += ids
            if len(block) >= DECODE_TOKENS:
                flush()
        if block:
            flush()
        damaged |= bool(stream.close())
        yield doc_id, n, listed.hexdigest(), decoded.hexdigest(), not damaged or "�" in (text or "")

    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(
        asked,
        by_row(rows, ("doc_id", "text"), schema, _task_ends(ranks_path, pattern)),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, valid_utf8 boolean",
    )

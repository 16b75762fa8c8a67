"""SentencePiece (merge type) encoding and decoding by a prefix table.

For every prefix of a stretch of text the table holds the one token that ends the prefix's encoding. A candidate for
that token is any piece that an automaton finds ending there; it is the right one if it and the last token of the
prefix before it are compatible, that is, if merging the two pieces' characters alone gives these two pieces again.
Ids are then recovered backwards. Pieces never hold a blank mark after another character (checked when a model is
loaded), so no merge crosses from a character to a blank mark, and stretches are encoded on their own and remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from .common import held_for, mapped, pick

MARK = "▁"
#: Types of a piece in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
LIMIT = 200_000  # remembered stretches in a worker, and as many older ones
PAIRS = 1_000_000  # remembered pairs in a worker
NONE, START, ALONE = -3, -2, -1  # in place of an id: no encoding ends here; nothing before; a character without a piece
LONG = 64  # characters of a stretch worth remembering


class Pieces:
    """A merge-type model with byte fallback, an identity normaliser and a dummy prefix."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb2

        proto = pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != 2 or proto.normalizer_spec.precompiled_charsmap:
            raise ValueError("only merge-type models with an identity normaliser are supported")
        if proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.add_dummy_prefix:
            raise ValueError("white space must be kept and a dummy prefix added")
        if any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.text = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte = {}
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte[int(p.piece[1:-1], 16)] = i
        self.byte_of = {i: b for b, i in self.byte.items()}
        if len(self.byte) != 256:
            raise ValueError("the model has no full byte fallback")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a blank mark after another character")
        #: for pieces of several characters, the rank from 1 of the merge that makes them; 0 for single characters
        ranked = sorted((i for p, i in self.ids.items() if len(p) > 1), key=lambda i: -self.score[i])
        self.made = [0] * len(self.text)
        for k, i in enumerate(ranked, 1):
            self.made[i] = k
        often = Counter(self.score[i] for i in ranked)
        self.tied = frozenset(i for i in ranked if often[self.score[i]] > 1)  # pieces of one score, such as runs of marks
        self.split: dict[int, tuple[int, int]] = {}
        self.single = frozenset(p for p in self.ids if len(p) == 1)
        self.matches = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.matches.add_word(p, (i, len(p)))
        self.matches.make_automaton()
        self.fits: dict[int, bool] = {}
        self.known = Known(self)

    # -- the prefix table ------------------------------------------------------------------------------------------
    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces' characters, merged alone, end as these two pieces.

        The merges that made the pieces are undone, the last one first. Whenever the two ends at the boundary could have
        been merged before the merge undone last (at the same rank the leftmost is first), the boundary was crossed.
        """
        own, text, made, tied, pair = self.ids, self.text, self.made, self.tied, [self.text[left], self.text[right]]
        limit = len(text) + 1
        while True:
            if left in tied or right in tied:  # their merges are not told apart by rank
                return self.merged("".join(pair)) == pair
            over = own.get(text[left] + text[right])
            if over is not None and made[over] < limit:
                return False
            a, b = made[left], made[right]
            if not (a or b):
                return True
            if a > b:
                halves, limit = self.halves(left), a
                left = halves[1]
            else:
                halves, limit = self.halves(right), b + 1
                right = halves[0]
            if halves[0] < 0:  # no merges end in this piece
                return False

    def halves(self, piece: int) -> tuple[int, int]:
        """What the last merge of a piece joins; -1 where its characters do not merge to it."""
        got = self.split.get(piece)
        if got is None:
            parts = self.merged(self.text[piece], 2)
            fine = len(parts) == 2 and parts[0] in self.ids and parts[1] in self.ids
            got = self.split[piece] = (self.ids[parts[0]], self.ids[parts[1]]) if fine else (-1, -1)
        return got

    def fit(self, left: int, right: int) -> bool:
        """compatible(), remembered."""
        if len(self.fits) > PAIRS:
            self.fits.clear()
        got = self.fits[left << 32 | right] = self.compatible(left, right)
        return got

    def merged(self, chars: str, most: int = 0) -> list[str]:
        """The greedy merges of a short string: best score first, leftmost among equals; no more once `most` parts are left."""
        parts = list(chars)
        while True:
            if len(parts) <= most:
                return parts
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stretch(self, chars: str) -> list[int]:
        """Ids of a stretch; a character that no piece covers becomes its bytes."""
        n, fits, own = len(chars), self.fits, self.ids
        last = [NONE] * (n + 1)
        last[0] = START
        size = [0] * (n + 1)
        if self.single.issuperset(chars):  # every character is a piece, so no place is settled without a match
            for end, (i, k) in self.matches.iter(chars):
                end += 1
                if last[end] != NONE:
                    continue
                left = last[end - k]
                if left >= 0:
                    fit = fits.get(left << 32 | i)
                    if fit is None:
                        fit = self.fit(left, i)
                else:
                    fit = left != NONE
                if fit:
                    last[end], size[end] = i, k
            out, end = [], n
            while end and last[end] >= 0:
                out.append(last[end])
                end -= size[end]
            if end:
                raise ValueError(f"no encoding ends {chars[:40]!r}")
            return out[::-1]
        done = 0  # all prefixes of up to so many characters are settled
        for end, (i, k) in self.matches.iter(chars):
            end += 1
            if last[end] != NONE:
                continue
            while done < end - 1:
                done += 1
                if chars[done - 1] not in own:
                    last[done], size[done] = ALONE, 1
            left = last[end - k]
            if left >= 0:
                fit = fits.get(left << 32 | i)
                if fit is None:
                    fit = self.fit(left, i)
            else:  # at the start, or after a character without a piece, anything fits; NONE: no encoding ends there
                fit = left != NONE
            if fit:
                last[end], size[end] = i, k
        while done < n:
            done += 1
            if chars[done - 1] not in own:
                last[done], size[done] = ALONE, 1
        out, end = [], n
        while end:
            i = last[end]
            if i == NONE:
                raise ValueError(f"no encoding ends {chars[:40]!r}")
            out += [i] if i >= 0 else [self.byte[b] for b in reversed(chars[end - 1].encode("utf-8", "replace"))]
            end -= size[end]
        return out[::-1]

    def described(self, chars: str) -> tuple[str, int, str | None]:
        """Ids joined by commas, their number, and the decoded text of a stretch; None where only its marks are replaced."""
        ids = self.stretch(chars)
        return ",".join(map(str, ids)), len(ids), None if self.byte_of.keys().isdisjoint(ids) else self.surface(ids)

    # -- whole texts -----------------------------------------------------------------------------------------------
    @staticmethod
    def stretches(text: str) -> list[str]:
        """The text with a dummy prefix, cut before each blank mark that follows another character."""
        return CUT.findall(MARK + text.replace(" ", MARK)) if text else []

    def digest(self, text: str) -> tuple[str, int, str]:
        parts = self.stretches(text)
        if not parts:
            return "", 0, ""
        ids, sizes, decoded = zip(*map(self.known.__getitem__, parts), strict=True)
        if any(d is not None for d in decoded):
            whole = "".join([c.replace(MARK, " ") if d is None else d for c, d in zip(parts, decoded, strict=True)])[1:]
        else:
            whole = text.replace(MARK, " ")
        return ",".join(ids), sum(sizes), whole

    def encode(self, text: str) -> list[int]:
        return [int(i) for s in self.stretches(text) for i in self.known[s][0].split(",")]

    def surface(self, ids: list[int]) -> str:
        """The text of ids, a blank mark as a space; runs of bytes become characters, each stray byte U+FFFD."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(lenient(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.text[i].replace(MARK, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids)
        return text[1:] if text.startswith(" ") else text


class Known(dict):
    """stretch -> what Pieces.described() says of it, for the stretches met last; the ones before them are kept once more."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.older = pieces, {}

    def __missing__(self, chars: str) -> tuple[str, int, str | None]:
        got = self.older.get(chars)
        if got is None:
            got = self.pieces.described(chars)
        if len(chars) <= LONG:
            if len(self) >= LIMIT:
                self.older = dict(self)
                self.clear()
            self[chars] = got
        return got


CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def lenient(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for k in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + k].decode())
                    at += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def loaded(model: bytes) -> Pieces:
    """One automaton for each model in a Python worker."""
    own, key = held_for("op9"), hashlib.sha256(model).hexdigest()
    if key not in own:
        own.clear()
        own[key] = Pieces(model)
    return own[key]


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded of each row.

    A null text is an empty one: no ids, an empty decoded text. Nothing is shuffled; the model file is read by the
    driver and shipped (a vocabulary file, half a megabyte), so executors need no file of their own.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    if len(model) > 64_000_000:
        raise ValueError("this is no vocabulary file")
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def row(pieces: Pieces, doc_id: int | None, text: str | None) -> tuple:
        ids, n, decoded = pieces.digest(text or "")
        hashes = hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        more = (np.array(ids.split(","), np.int32) if ids else np.zeros(0, np.int32), decoded) if with_ids else ()
        return doc_id, n, *hashes, *more

    return mapped(
        pick(docs, id_col, text_col), row, schema + ", ids array<int>, decoded string" * with_ids, lambda: loaded(held.value), True
    )

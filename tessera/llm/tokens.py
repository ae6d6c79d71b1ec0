"""Byte-level BPE: token ids, and the token count at every prefix of a text.

Merges run in the tiktoken core.  For prefix counts, a unit is a
space-delimited run together with its leading space; the
pre-tokenizer never joins a unit with the next one when exactly one space
stands between two non-space characters, so the counts inside such a text are
those inside its units plus the tokens before them, and a small cache of units
answers most of a corpus without running merges again.  Texts with other white
space go through the pre-token pattern.

The caches are bounded (cleared when full) and live in the Python worker.
"""
from __future__ import annotations

import json
import re

import numpy as np
import regex

#: Fixed value: the split pattern of the byte-level pre-tokenizer.
PIECE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CACHE_UNITS = 250_000
#: Units up to this many characters are cached; their counts fit one byte.
_UNIT_CHARS = 48
_NARROW = 0x250


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for raw bytes."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in keep}
    rest = [b for b in range(256) if b not in set(keep)]
    table.update({chr(256 + i): b for i, b in enumerate(rest)})
    return table


def _narrow_pattern() -> re.Pattern:
    """The same split for texts below U+0250, with explicit classes, on the
    faster standard engine."""
    chars = [chr(i) for i in range(_NARROW)]
    members = lambda p: "".join(re.escape(c) for c in chars if regex.fullmatch(p, c))
    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


class _Cache(dict):
    """A bounded memo: cleared when full, long keys are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        got = self.make(key)
        if len(key) <= _UNIT_CHARS:
            if len(self) >= _CACHE_UNITS:
                self.clear()
            self[key] = got
        return got


class ByteBPE:
    """Token ids and prefix counts of a byte-level BPE given by a
    ``tokenizers`` JSON file; special strings inside a text are tokens, as the
    library has it by default; no begin or end tokens are added."""

    def __init__(self, path: str):
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"not a plain byte-level BPE: {path}")
        raw = _byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        ranks = {bytes(raw[c] for c in tok): i for tok, i in model["vocab"].items() if tok not in self.special}
        self.vocab_size = max([*ranks.values(), *self.special.values()]) + 1
        self._encoding = tiktoken.Encoding("unit", pat_str=PIECE_PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self._core = self._encoding._core_bpe
        self._wide, self._small = regex.compile(PIECE_PATTERN), _narrow_pattern()
        self._is_narrow = re.compile(f"[\x00-{chr(_NARROW - 1)}]*").fullmatch
        # white space at either end, or two next to each other: units are not self-contained
        self._odd_space = re.compile(r"^\s|\s\s|\s\Z").search
        self._split_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self._piece_counts = _Cache(self._make_piece_counts)
        self._unit_counts = _Cache(lambda unit: self._make_unit_counts(" " + unit))

    # ---- pieces ---------------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        return (self._small if self._is_narrow(text) else self._wide).findall(text)

    # ---- ids ------------------------------------------------------------
    def ids(self, text: str) -> list[int]:
        """Token ids of the whole text."""
        return self._encoding.encode(text, allowed_special="all")

    # ---- prefix counts --------------------------------------------------
    def _count(self, text: str) -> int:
        """Tokens of a short text from its pieces."""
        return sum(len(self._core.encode_single_piece(p.encode())) for p in self.pieces(text))

    def piece_counts(self, piece: str) -> np.ndarray:
        """Tokens of piece[:1], piece[:2], ..., piece, one for each character."""
        kind = np.uint8 if len(piece) <= _UNIT_CHARS else np.int64
        return np.frombuffer(self._piece_counts[piece], kind)

    def _make_piece_counts(self, piece: str) -> bytes:
        """One byte a prefix for a short piece, int64 for a long one."""
        if len(piece) > _UNIT_CHARS:
            return self._long_counts(piece).tobytes()
        if piece[0] == "'" and len(piece) > 1:  # a cut contraction splits differently
            return bytes(self._count(piece[:k]) for k in range(1, len(piece) + 1))
        encode = self._core.encode_single_piece
        if piece.isascii():
            raw = piece.encode()
            return bytes([len(encode(raw[:k])) for k in range(1, len(raw) + 1)])
        return bytes([len(encode(piece[:k].encode())) for k in range(1, len(piece) + 1)])

    def _make_unit_counts(self, unit: str) -> bytes:
        if len(unit) <= _UNIT_CHARS:
            out = b""
            for p in self.pieces(unit):
                local = self._piece_counts[p]
                out += bytes([c + out[-1] for c in local]) if out else local
            return out
        return self._counts_of(self.pieces(unit)).tobytes()

    def _counts_of(self, pieces: list[str]) -> np.ndarray:
        parts, base = [], 0
        for p in pieces:
            parts.append(self.piece_counts(p) + np.int64(base))
            base = int(parts[-1][-1])
        return np.concatenate(parts)

    def _long_counts(self, piece: str) -> np.ndarray:
        """Prefix dynamic programming for one long piece, linear in its length.

        The encoding of a prefix is the encoding of a shorter prefix plus one
        last token; a token may follow another exactly when encoding the two
        joined gives back the two.  So count[i] = count[i - len(t)] + 1 for the
        only vocabulary token t that ends at i and may follow the last token
        of the prefix before it.
        """
        raw, core = piece.encode(), self._core
        ranks = self._token_bytes()
        longest = max(map(len, ranks))
        last: list[bytes] = [b""]
        count = [0]
        fits: dict[tuple[bytes, bytes], bool] = {}
        for i in range(1, len(raw) + 1):
            for n in range(min(longest, i), 0, -1):
                token = raw[i - n:i]
                if token not in ranks:
                    continue
                before = last[i - n]
                ok = not before
                if before:
                    ok = fits.get((before, token))
                    if ok is None:
                        ok = fits[before, token] = [len(x) for x in map(self._decode, core.encode_single_piece(before + token))] == [len(before), n]
                if ok and (before or len(core.encode_single_piece(token)) == 1):
                    last.append(token)
                    count.append(count[i - n] + 1)
                    break
        ends = np.cumsum([len(c.encode()) for c in piece])
        return np.array(count, np.int64)[ends]

    def _token_bytes(self) -> set[bytes]:
        if not hasattr(self, "_tokens"):
            self._tokens = set(self._core.token_byte_values())
        return self._tokens

    def _decode(self, token: int) -> bytes:
        return self._core.decode_single_token_bytes(token)

    def _plain_prefix_counts(self, text: str) -> np.ndarray:
        units = text.split(" ")
        if not self._odd_space(text) and max(map(len, units)) < _UNIT_CHARS:
            parts = [self._counts_of(self.pieces(units[0])).astype(np.uint8).tobytes(),
                     *map(self._unit_counts.__getitem__, units[1:])]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            local = np.frombuffer(b"".join(parts), np.uint8)
            totals = local[np.cumsum(lengths) - 1].astype(np.int64)
            return np.repeat(np.cumsum(totals) - totals, lengths) + local
        counts = self._counts_of(self.pieces(text))
        # A prefix that ends with a whole run of white space has that run as one
        # piece, though in the full text its last space belongs to what follows.
        for m in re.finditer(r"\s{2,}", text):
            k = m.end()
            if k < len(text):
                counts[k - 1] = (counts[m.start() - 1] if m.start() else 0) + self._count(m.group())
        return counts

    def prefix_counts(self, text: str) -> np.ndarray:
        """int64 of len(text): tokens of text[:1], text[:2], ..., text, exactly
        as encoding each prefix on its own gives them."""
        if not text:
            return np.zeros(0, np.int64)
        if self._split_special is None or not self._split_special.search(text):
            return self._plain_prefix_counts(text)
        out, at, base = [], 0, 0
        for m in self._split_special.finditer(text):
            # inside the special string a prefix holds it as ordinary text
            part = self._plain_prefix_counts(text[at:m.end()]) + base
            part[-1] = base = (part[m.start() - at - 1] if m.start() > at else base) + 1
            out.append(part)
            at = m.end()
        if at < len(text):
            out.append(self._plain_prefix_counts(text[at:]) + base)
        return np.concatenate(out)


_LOADED: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """One instance per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]

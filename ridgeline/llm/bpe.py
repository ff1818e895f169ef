"""Byte-level BPE: the vocabulary, splitting texts, and two ways to apply the merges.

* :class:`MergeCounter` keeps a piece's symbols in a linked list and its adjacent pairs in a heap, pops the pair of lowest
  rank again and again, and needs only the number of merges to give the token count.
* :class:`BacktrackEncoder` finds all tokens in a piece with an Aho-Corasick automaton (bytes as Latin-1), walks from
  longest matches and steps back where adjacent tokens could not stand side by side in a correct encoding.
"""

from __future__ import annotations

import base64
import heapq
import json

import regex

#: White space as the tokenizer libraries' ``\s`` has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries of each half of a memo; they bound a worker's memory whatever the vocabulary of the texts.
MEMO_ENTRIES = 300_000
LONGEST_KEPT = 64
#: A rank after all others.
NEVER = 1 << 40


class Memo:
    """A dictionary of bounded size in two halves: when the young half is full, it takes the place of the old one.
    Entries in use return to the young half."""

    def __init__(self, entries: int = MEMO_ENTRIES):
        self.entries, self.young, self.old = entries, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value):
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}
        self.young[key] = value
        return value


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a .json vocabulary, by rule: printable Latin-1 bytes stand for
    themselves, the others follow from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_from_tiktoken(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merges_from_json(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Merge ranks by pair of byte strings, and the special tokens' strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    plain = lambda s: bytes(alphabet[c] for c in s)
    pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
    merges = {(plain(a), plain(b)): i for i, (a, b) in enumerate(pairs)}
    return merges, [t["content"] for t in spec.get("added_tokens", [])]


def pieces_pattern(pattern: str) -> regex.Pattern:
    """``pattern`` with ``\\s`` and ``\\S`` spelled out, so that control characters count as the libraries count them."""
    spelled = pattern.replace(r"(?!\S)", f"(?![^{SPACE}])").replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]")
    return regex.compile(spelled)


_ODD_SPACE = regex.compile(r" (?=[\s\x1c-\x1f]|\Z)")
_END_MARKS = frozenset(".,;:?!)")


def chunks(text: str) -> list[str]:
    """Cut ``text`` at each space that a character other than white space follows.  Pieces never cross such a cut, so
    chunks can be remembered whole.  All chunks but the first are given without the space that they begin with."""
    parts = text.split(" ")
    if _ODD_SPACE.search(text) is None:
        return parts
    out = parts[:1]
    for part in parts[1:]:
        if part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


def pieces(chunk: str, pattern: regex.Pattern) -> list[str]:
    """The pattern's matches in a chunk.  Most chunks are a word and perhaps a mark, which needs no pattern."""
    word = chunk[1:] if chunk[:1] == " " else chunk
    if word.isalpha():
        return [chunk]
    if word[-1:] in _END_MARKS and word[:-1].isalpha():
        return [chunk[:-1], chunk[-1]]
    return pattern.findall(chunk)


def splitter(pattern: str):
    """The function that cuts chunks into pieces.  The shortcut holds for patterns that keep letters together with a space
    before them and give marks apart."""
    compiled = pieces_pattern(pattern)
    samples = {"ab": ["ab"], " éñ": [" éñ"], " ab.": [" ab", "."], "ab)": ["ab", ")"]}
    if all(compiled.findall(k) == v for k, v in samples.items()):
        return lambda chunk: pieces(chunk, compiled)
    return compiled.findall


class MergeCounter:
    """Token counts of texts without identifiers.  Each piece's count is its bytes minus its merges."""

    def __init__(self, merges: dict[tuple[bytes, bytes], int], pattern: str, specials: list[str] = ()):
        self.split = splitter(pattern)
        self.specials = regex.compile("|".join(regex.escape(s) for s in specials)) if specials else None
        self.chunks, self.pieces = Memo(), Memo()
        # Symbols are numbers, bytes first.  A pair of symbols gives its rank and the symbol that it becomes.
        symbols = {bytes([b]): b for b in range(256)}
        for left, right in merges:
            symbols.setdefault(left + right, len(symbols))
        self.pairs = {
            symbols[a] << 20 | symbols[b]: (rank, symbols[a + b]) for (a, b), rank in merges.items() if a in symbols and b in symbols
        }

    def piece(self, data: bytes) -> int:
        """Merge the adjacent pair of lowest rank, leftmost first, until none can be merged."""
        n = len(data)
        if n < 2:
            return n
        pairs, symbols = self.pairs, list(data)
        heap = []  # rank and place of each pair that can be merged, as one number
        for i in range(n - 1):
            if (found := pairs.get(symbols[i] << 20 | symbols[i + 1])) is not None:
                heap.append(found[0] << 32 | i)
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            item = heapq.heappop(heap)
            i = item & 0xFFFFFFFF
            if symbols[i] < 0 or (j := after[i]) >= n:
                continue
            found = pairs.get(symbols[i] << 20 | symbols[j])
            if found is None or found[0] != item >> 32:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = found[1], -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (found := pairs.get(symbols[i] << 20 | symbols[k])) is not None:
                    heapq.heappush(heap, found[0] << 32 | i)
            if (h := before[i]) >= 0 and (found := pairs.get(symbols[h] << 20 | symbols[i])) is not None:
                heapq.heappush(heap, found[0] << 32 | h)
        return left

    def _fresh(self, chunk: str) -> int:
        total = 0
        for piece in self.split(chunk):
            n = self.pieces.get(piece)
            if n is None:
                n = self.piece(piece.encode())
                if len(piece) <= LONGEST_KEPT:
                    self.pieces.put(piece, n)
            total += n
        return total

    def _ordinary(self, text: str) -> int:
        parts = chunks(text)
        total = self._fresh(parts[0])
        counts = list(map(self.chunks.young.get, parts))
        for part, n in zip(parts[1:], counts[1:]) if None in counts[1:] else ():
            if n is None:
                n = self.chunks.get(part)
                if n is None:
                    n = self._fresh(" " + part)
                    if len(part) <= LONGEST_KEPT:
                        self.chunks.put(part, n)
                total += n
        return total + sum(n for n in counts[1:] if n is not None)

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special token's string inside it is one token."""
        if self.specials is None:
            return self._ordinary(text)
        found = len(self.specials.findall(text))
        if not found:
            return self._ordinary(text)
        return found + sum(map(self._ordinary, self.specials.split(text)))


class BacktrackEncoder:
    """Exact BPE encoding by longest matches with backtracking; decoding joins token bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick

        self.ranks, self.split = ranks, splitter(pattern)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.chunks, self.pieces, self.fits = Memo(), Memo(), Memo(2 * MEMO_ENTRIES)
        self.size = [0] * (max(ranks.values(), default=-1) + 1)
        self.shorter = [-1] * len(self.size)  # the longest token that is a proper prefix of each
        for token, i in ranks.items():
            self.size[i] = len(token)
            self.shorter[i] = next((t for k in range(len(token) - 1, 0, -1) if (t := ranks.get(token[:k])) is not None), -1)
        self.edges: dict[int, tuple] = {}

    def _edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the right and at the left end of ``token`` while it is merged: (bytes, rank of the merge that
        ends it), from the single byte to the token itself.  None if the merges don't lead to the token."""
        got = self.edges.get(token)
        if got is None:
            data = self.bytes_of[token]
            if len(data) == 1:
                got = [(data, NEVER)], [(data, NEVER)]
            else:
                parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
                while len(parts) > 2:
                    rank, i = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                    if rank >= token:
                        break
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if len(parts) == 2:
                    ends = [self._edges(ranks[p]) if p in ranks else None for p in parts]
                    if None not in ends:
                        right, left = ends[1][0], ends[0][1]
                        got = [*right[:-1], (right[-1][0], token), (data, NEVER)], [*left[:-1], (left[-1][0], token), (data, NEVER)]
            self.edges[token] = got = got or ()
        return got or None

    def _compatible(self, a: int, b: int) -> bool:
        """Whether tokens a and b stand side by side in the encoding of their bytes; a correct encoding is one in which all
        neighbours do.  They don't if, while both are merged, what ends a and what begins b have a merge that comes
        before the next merge of either, the left one first at equal ranks.  For a < 0, whether the merges lead to b."""
        got = self.fits.get(a << 20 | b)
        if got is None:
            first, second = a < 0 or self._edges(a), self._edges(b)
            got = bool(first and second)
            if got and a >= 0:
                ends, begins, ranks, i, j = first[0], second[1], self.ranks, 0, 0
                while True:
                    (x, x_until), (y, y_until) = ends[i], begins[j]
                    rank = ranks.get(x + y, NEVER)
                    if rank < x_until and rank <= y_until and rank != NEVER:
                        got = False
                        break
                    if x_until == y_until == NEVER:
                        break
                    if x_until <= y_until:
                        i += 1
                    else:
                        j += 1
            self.fits.put(a << 20 | b, got)
        return got

    def piece(self, data: bytes) -> tuple[int, ...]:
        """Go from longest matches to shorter ones where neighbours don't fit, and a token back where none does.  The
        tokens before a place are the one encoding of the bytes before it, so a place without a way on is never tried
        again and each is left once."""
        whole = self.ranks.get(data)
        if whole is not None and self._compatible(-1, whole):
            return (whole,)
        n, size, shorter, fits = len(data), self.size, self.shorter, self.fits.young
        longest = [-1] * n
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - size[token] + 1] = token  # ends grow, so the longest stays
        dead = bytearray(n + 1)
        tokens: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    fit = fits.get(last << 20 | token)
                    if fit or fit is None and self._compatible(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == n:
                    return tuple(tokens)
                at, last, token = end, token, longest[end]
            elif tokens:
                dead[at] = 1
                token = tokens.pop()
                at -= size[token]
                last, token = tokens[-1] if tokens else -1, shorter[token]
            else:
                raise ValueError("the vocabulary lacks a byte of the text")

    def _fresh(self, chunk: str) -> tuple[int, ...]:
        found: list[int] = []
        for piece in self.split(chunk):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.piece(piece.encode())
                if len(piece) <= LONGEST_KEPT:
                    self.pieces.put(piece, ids)
            found += ids
        return tuple(found)

    def encode(self, text: str) -> list[int]:
        parts = chunks(text)
        out = list(self._fresh(parts[0]))
        for part in parts[1:]:
            ids = self.chunks.young.get(part)
            if ids is None:
                ids = self.chunks.get(part)
                if ids is None:
                    ids = self._fresh(" " + part)
                    if len(part) <= LONGEST_KEPT:
                        self.chunks.put(part, ids)
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

"""Byte-pair encoding by dynamic programming over prefixes.

For every prefix of a word the encoding ends in exactly one token. An automaton over the vocabulary
yields, at every end position, the tokens that are suffixes of the prefix there; a suffix token is
the last one iff it may stand beside the last token of the prefix before it. Two tokens may stand
side by side iff no merge across their border would have happened before the merges that built
them. Back-pointers then give the exact ids, and a counter per prefix gives exact token counts
without any encoding.

Two vocabularies are read: a ``tokenizers`` BPE with word ends (``WordBpe``) and a sentencepiece
BPE with byte fallback (``PieceBpe``). Only files of the path given are read; nothing is trained.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from functools import lru_cache

import ahocorasick
import regex

#: Words kept in a worker's cache; beyond that it starts afresh. It bounds memory, never results.
CACHE_WORDS = 150_000
FOREVER = 1 << 60


class PrefixTable:
    """Vocabulary with merge ranks: ``last_tokens(word)`` gives the last token of each prefix.

    spell: token -> its string over single-symbol characters; rank: token -> when it may be made
    (None: a base symbol); parts: token -> the two tokens it is made of; joined(a, b): the token a
    merge of a and b gives, or None.
    """

    def __init__(self, spell, rank, parts, joined):
        self.spell, self.rank, self.parts, self.joined = spell, rank, parts, joined
        self.born: dict = {}
        for t in sorted(spell, key=lambda t: len(spell[t])):
            self.born[t] = -1 if parts.get(t) is None else max(rank[t], *(self.born[x] for x in parts[t]))
        self.right: dict = {}
        self.left: dict = {}
        self.pairs: dict = {}
        self.automaton = ahocorasick.Automaton()
        for t, s in spell.items():
            if self._whole(t):
                self.automaton.add_word(s, (t, len(s)))
        self.automaton.make_automaton()

    def _edge(self, t, side: int) -> list:
        """The symbols at a border of t as it is built: (token, born, when it is merged away)."""
        known = self.right if side else self.left
        if t not in known:
            chain, gone, x = [], FOREVER, t
            while x is not None:
                chain.append((x, self.born[x], gone))
                gone = self.born[x]
                x = self.parts[x][side] if self.parts.get(x) else None
            known[t] = chain
        return known[t]

    def _meets(self, a, b, but=None) -> bool:
        """Whether some merge joins symbols across the border of a and b before their own merges end it."""
        for x, x_born, x_gone in self._edge(a, 1):
            for y, y_born, y_gone in self._edge(b, 0):
                made = self.joined(x, y)
                if made is None or (x, y) == but:
                    continue
                at = max(self.rank[made], x_born, y_born)
                # Of equal ranks the left merge goes first: one that takes x wins, one that takes y loses.
                if at < x_gone and at <= y_gone:
                    return True
        return False

    def _whole(self, t) -> bool:
        """Whether the encoding of t's own string is t."""
        p = self.parts.get(t)
        return p is None or not self._meets(p[0], p[1], but=p)

    def fit(self, a, b) -> bool:
        """Whether a and b may stand side by side."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            got = self.pairs[a, b] = not self._meets(a, b)
        return got

    def last_tokens(self, s: str) -> tuple[list, list]:
        """(last, start): for each prefix length of s its last token (None where none) and where that begins."""
        n = len(s)
        last, start = [None] * (n + 1), [0] * (n + 1)
        fit = self.fit
        for end, (t, size) in self.automaton.iter(s):
            i = end + 1
            j = i - size
            if last[i] is None and (not j or (last[j] is not None and fit(last[j], t))):
                last[i], start[i] = t, j
        return last, start


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(moved)) for b in range(256)]


def odd_characters() -> bytearray:
    """By code point 1 for characters that the library's Unicode tables may see otherwise than Python's: unassigned ones, and whatever differs in
    class, lower case, composition or combining class. Texts without them are split alike by both."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    kinds = {chr(c): unicodedata.category(chr(c)) for c in range(128, 0x110000)}
    odd = {c for c, k in kinds.items() if k == "Cn"}
    every = [c for c, k in kinds.items() if k not in ("Cn", "Co", "Cs")]
    whole = "".join(every)
    for theirs, ours in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", f"[{WordBpe.SPACE}]")):
        runs = pre_tokenizers.Split(Regex(f"(?:{theirs})+"), "removed").pre_tokenize_str(whole)
        outside = {i for _, (a, b) in runs for i in range(a, b)}
        inside = {m.start() for m in regex.finditer(ours, whole)}
        odd |= {c for i, c in enumerate(every) if (i in outside) == (i in inside)}

    def differ(rule, mine, form):
        theirs = rule.normalize_str("\n".join(map(form, every))).split("\n")
        return {c for c, x in zip(every, theirs, strict=True) if x != mine(form(c))}

    # The last two show whether a mark before or after the character changes places with it.
    for form in (str, lambda c: f"a{c}\u0334", lambda c: f"a\u0345{c}"):
        odd |= differ(normalizers.NFC(), lambda x: unicodedata.normalize("NFC", x), form)
    odd |= differ(normalizers.Lowercase(), lambda x: x.replace("Σ", "σ").lower(), str)
    table = bytearray(0x110000)
    for c in odd:
        table[ord(c)] = 1
    return table


class WordBpe:
    """The file word_bpe_49k.json: NFC, lower case, white space dropped, merges inside words, word ends.

    A text with a character that the library's Unicode tables may see otherwise than Python's is normalised and split by the
    library; the encoding itself is always that of the prefix programme.
    """

    #: White space as the library's pattern engine has it.
    SPACE = r"\t-\r \x85\xa0  -     　"
    END = "\x00"

    def __init__(self, path: str):
        d = json.load(open(path, encoding="utf-8"))
        model = d["model"]
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {a["content"]: a["id"] for a in d["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        rank, parts, joined = {}, {}, {}
        for r, (a, b) in enumerate(merges):
            t = vocab[a + b]
            rank[t], parts[t] = r, (vocab[a], vocab[b])
            joined[vocab[a], vocab[b]] = t
        special = set(self.special.values())
        spell = {i: t[: -len(suffix)] + self.END if t.endswith(suffix) else t for t, i in vocab.items() if i not in special}
        self.table = PrefixTable(spell, rank, parts, lambda a, b: joined.get((a, b)))
        self.bytes = _byte_symbols()
        # Fixed pattern of the vocabulary file.
        self.pieces = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{self.SPACE}\p{{L}}\p{{N}}]+").findall
        self.parted = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.odd = odd_characters()
        outer = self

        class Cache(dict):
            def __missing__(self, word):
                if len(self) > CACHE_WORDS:
                    self.clear()
                got = self[word] = outer._word(word)
                return got

        self.cache = Cache()

    def _word(self, word: str) -> bytes:
        """Ids of one word as little-endian 32-bit numbers, by back-pointers from its end."""
        return self._spelt("".join(map(self.bytes.__getitem__, word.encode("utf-8", "surrogatepass"))))

    def _spelt(self, word: str) -> bytes:
        s = word + self.END
        last, start = self.table.last_tokens(s)
        ids, i = [], len(s)
        while i:
            if last[i] is None:
                raise ValueError(f"no token ends the prefix of length {i}")
            ids.append(last[i])
            i = start[i]
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def encode(self, text: str | None) -> bytes:
        """Exact ids of a whole text, 4 bytes each."""
        if not text:
            return b""
        out = []
        for k, part in enumerate(self.parted(text) if "<|" in text else (text,)):
            if k % 2:
                out.append(struct.pack("<I", self.special[part]))
            elif part and not part.isascii() and any(map(self.odd.__getitem__, map(ord, set(part)))):
                part = self.library.normalizer.normalize_str(part)
                out += [self._spelt(word) for word, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
            elif part:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += map(self.cache.__getitem__, self.pieces(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by spaces; the file names no decoder, and special tokens stay."""
        return " ".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist() if ids else ()))


class PieceBpe:
    """The file piece_bpe_32k.model: a blank before the text, blanks as U+2581, characters outside it as bytes."""

    BLANK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        piece = {i: sp.id_to_piece(i) for i in ids}
        score = {i: sp.get_score(i) for i in ids}
        order = {x: k for k, x in enumerate(sorted({-v for v in score.values()}))}
        rank = {i: order[-score[i]] for i in ids}
        of = {s: i for i, s in piece.items()}
        single = {i for i, s in piece.items() if len(s) == 1}
        self.known = {piece[i] for i in single}
        # Parts of a piece: where a merge of its own characters ends. Characters the file lacks as pieces get own ids.
        lacking = {c for s in piece.values() for c in s} - self.known
        base = sp.get_piece_size()
        spell = dict(piece)
        for k, c in enumerate(sorted(lacking)):
            spell[base + k] = c
            of[c] = base + k
        self.lacking = lacking
        parts = {}
        for i, s in piece.items():
            if len(s) > 1 and (p := self._split(s, of, rank)):
                parts[i] = p
        spell = {i: s for i, s in spell.items() if len(s) == 1 or i in parts}
        self.bytes_of = {i: len(s.encode()) if i >= base else 1 for i, s in spell.items()}
        rank |= {i: -1 for i in spell if len(spell[i]) == 1}
        merged = {s: i for i, s in spell.items() if len(s) > 1}
        self.table = PrefixTable(spell, rank, parts, lambda a, b: merged.get(spell[a] + spell[b]))
        inside = {c for s in piece.values() for c in s if len(s) > 1}
        mixed = any(self.BLANK in s.lstrip(self.BLANK) for s in piece.values())
        # No piece has a blank after another character, so blanks begin new words; nor has one a line feed.
        if mixed:
            raise ValueError("pieces with blanks inside need whole texts")
        apart = "\n" if "\n" not in inside else ""
        self.words = regex.compile(f"{self.BLANK}+[^{self.BLANK}{apart}]*|[^{self.BLANK}{apart}]+" + (f"|{apart}" if apart else "")).findall
        outer = self

        class Cache(dict):
            def __missing__(self, word):
                if len(self) > CACHE_WORDS:
                    self.clear()
                got = self[word] = outer.prefix_counts_of(word)[-1]
                return got

        self.cache = Cache()

    @staticmethod
    def _split(s: str, of: dict, rank: dict):
        """The two pieces of the last merge when s's own characters are merged, or None if that doesn't give s."""
        x = list(s)
        while len(x) > 2:
            best = min(((rank[t], k) for k in range(len(x) - 1) if (t := of.get(x[k] + x[k + 1])) in rank), default=None)
            if best is None:
                return None
            k = best[1]
            x[k : k + 2] = [x[k] + x[k + 1]]
        return (of[x[0]], of[x[1]]) if len(x) == 2 and x[0] in of and x[1] in of else None

    def prefix_counts_of(self, word: str) -> list[int]:
        """Tokens of every prefix of a word (with its blanks, as U+2581, before it), from 0 characters to all."""
        s = word
        out = [0] * (len(s) + 1)
        cost = self.bytes_of
        known = self.table.automaton
        last = [None] * (len(s) + 1)
        fit = self.table.fit
        i = 0
        for end, (t, size) in known.iter(s):
            while i < end:  # characters no piece ends with: bytes
                i += 1
                if last[i] is None:
                    last[i], out[i] = -1, out[i - 1] + len(s[i - 1].encode())
            j = end + 1 - size
            if last[end + 1] is None and (not j or last[j] == -1 or (last[j] is not None and fit(last[j], t))):
                last[end + 1], out[end + 1] = t, out[j] + cost[t]
        while i < len(s):
            i += 1
            if last[i] is None:
                last[i], out[i] = -1, out[i - 1] + len(s[i - 1].encode())
        return out

    def _norm(self, text: str | None) -> list[str]:
        return self.words(self.BLANK + text.replace(" ", self.BLANK)) if text else []

    def count(self, text: str | None) -> int:
        """Exact token count of a whole text."""
        return sum(map(self.cache.__getitem__, self._norm(text)))

    def prefix_counts(self, text: str | None) -> list[int]:
        """Tokens of the text's prefixes of 0, 1, ... characters, each as the longer text has them up to there.

        Entry i is what encoding text[:i] alone gives; entry 0 is 0.
        """
        out, total = [], 0
        for word in self._norm(text):
            got = self.prefix_counts_of(word)
            out += (total + x for x in got[1:])
            total += got[-1]
        return [0, *out[1:]]

    def longest_within(self, text: str | None, budget: int) -> int:
        """The most characters whose encoding has at most budget tokens, from the stored prefix counts."""
        counts = self.prefix_counts(text)
        return max((i for i, n in enumerate(counts) if n <= budget), default=0)


@lru_cache(4)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(4)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)

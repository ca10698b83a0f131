"""Repairing text from scanned pages.

An averaged-perceptron character editor judges edit operations on suspicious words and line ends: keep, replace, delete,
insert (several read characters for one printed, or the reverse) and join (over a blank or a line end). It is trained
here, on clean pages of the corpus that are damaged at random with known confusions. Running headers, footers and page
numbers are told by position: a line of furniture stands at the edge of several pages of its file, or of several files,
and lines of its shape hardly ever stand inside a page; a printed page number follows the place of the page.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import materialize

# What scanners read for what is printed, as "printed read".
CONFUSIONS = [
    tuple(x.split())
    for x in (
        "e c;c e;i 1;i !;i l;l 1;l I;l i;l |;I l;1 l;a o;o a;n ri;t f;f t;s $;o 0;O 0;O Q;u ii;m rn;d cl;c (;t l;g 9;h b;b h;"
        "cl d;S 5;s 5;B 8;w vv;h li;b 6;Z 2;E F;e o;ri n;rn m"
    ).split(";")
]
#: The edit that undoes each: printed, read, its kind and name.
_UNDO = [(p, r, "replace" if len(p) == len(r) else "insert" if len(p) > len(r) else "delete", f"{r}>{p}") for p, r in CONFUSIONS]
STRAY = "|~'.`^*_"
HYPHENS = "-‐‑¬­—–~"
#: A word is known from so many occurrences on.
TRUSTED_LEAST = 4
#: Known words on this share of the pages and more are sent to all tasks: at most tokens of a page / share words. Pages
#: get the counts of the others that they ask for by a join.
TRUSTED_SHARE = 5e-5
#: A word is taken for a misreading of another that is at least this many times as frequent.
RATIO = 12
#: Clean pages that the editor is trained on, at most (chosen by hash), and words it learns from, at most.
TRAINING_PAGES, TRAINING_WORDS = 900, 60_000
EPOCHS = 3
#: Size of the bitmap of edge lines, as a power of 2.
BITS = 24
#: Pages that carry numbers of one offset in a part of a file are at most so many apart.
NEAR = 10
#: Furniture lines are no longer than this.
LONGEST = 80
SEED = 13

_EDGE = "".join(c for c in map(chr, range(33, 48)) if c != "$") + ":;<=>?@[\\]^_`{|}~“”„‘’«»‚…·•¡¿±≤≥≈–—()"
_OPEN = "“”„‘’«»‚\"(["
_CODE = re.compile(r"^(?:[A-Z]{1,6}[-–]?\d+[A-Z]{0,3}|[A-Z0-9]{2,}(?:[-–/][A-Z0-9]+)*|\d[\d.,:/%-]*|[a-z]\d+|.*\d{3,}.*)$")
_LETTERS = re.compile(r"[^\W\d_]")
_FOUR_LETTERS = re.compile(r"(?:[\W\d_]*+[^\W\d_]){4}")
_NUMBER = re.compile(r"\d+")


def core(token: str) -> str:
    """A token without punctuation at its ends; a sign that may be a misread letter stays when letters follow it."""
    return token.strip(_EDGE)


class Perceptron:
    """Averaged perceptron over named features, one weight vector per class."""

    def __init__(self) -> None:
        self.w: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        self._sum: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        self._step = 1

    def score(self, label: str, features: list[str]) -> float:
        w = self.w.get(label)
        return sum([w.get(f, 0.0) for f in features]) if w else 0.0

    def update(self, label: str, features: list[str], by: float) -> None:
        w, s = self.w[label], self._sum[label]
        for f in features:
            w[f] += by
            s[f] += by * self._step

    def tick(self) -> None:
        self._step += 1

    def averaged(self) -> dict[str, dict[str, float]]:
        return {c: {f: v - self._sum[c][f] / self._step for f, v in w.items() if v - self._sum[c][f] / self._step} for c, w in self.w.items()}


def operations(word: str, known: dict[str, int], least: int = 0) -> list[tuple[str, str, int, str]]:
    """(kind, what, place, result) of the single edits of a word that give a known word: replace, insert, delete."""
    out = []
    for printed, read, kind, what in _UNDO:
        if read not in word:
            continue
        at = word.find(read)
        while at >= 0:
            made = word[:at] + printed + word[at + len(read) :]
            if known.get(made, 0) > least:
                out.append((kind, what, at, made))
            at = word.find(read, at + 1)
    if word.isalnum():
        return out
    for at in range(1, len(word) - 1):
        if word[at] in STRAY:
            made = word[:at] + word[at + 1 :]
            if known.get(made, 0) > least:
                out.append(("delete", word[at], at, made))
    return out


def standing(token: str, known: dict[str, int]) -> str:
    """The word of a token: without the punctuation around it, but with a bracket that stands for a letter."""
    c = core(token)
    if token[:1] == "(" and ")" not in token and c and ("c" + c in known) and c not in known:
        return "(" + c
    return c


def _bucket(n: float) -> int:
    return min(9, max(0, int(n).bit_length() // 2))


def lasting(word: str, op: tuple[str, str, int, str], known: dict[str, int], trusted_least: int) -> tuple[list[str], str, str]:
    """Features of an edit that don't depend on the page (what it is, where, how frequent both words are), shape, ratio."""
    kind, what, at, made = op
    own, new = known.get(word, 0), known.get(made, 0)
    odd = sum(not c.isalpha() for c in word)
    shape = f"{'A' if word[:1].isupper() else 'a'}{min(odd, 2)}{int(any(c.isupper() for c in word[1:]) and any(c.islower() for c in word))}"
    ratio = f"r:{_bucket(new / max(own, trusted_least / 2))}"
    left, right = word[at - 1 : at] or "^", word[at + len(what.split(">")[0]) :][:1] or "$"
    size = min(len(word), 10)
    return ["bias", f"k:{kind}", f"w:{what}", ratio, f"n:{_bucket(new)}", f"o:{_bucket(own)}", f"s:{shape}", f"len:{size}", f"w:{what} {ratio}", f"w:{what} l:{left}", f"w:{what} x:{right}", f"len:{size} {ratio}"], f"s:{shape}", ratio


def passing(shape: str, ratio: str, votes: int, hint: bool) -> list[str]:
    """Features of an edit from the page: how often its like occurs there, and the hint."""
    few = min(votes, 3)
    return [f"v:{min(votes, 5)}", f"{shape} v:{few}", f"v:{min(votes, 5)} {ratio}", f"h:{int(hint)} v:{few}"]


def features(word: str, op: tuple[str, str, int, str], known: dict[str, int], trusted_least: int, votes: int, hint: bool) -> list[str]:
    always, shape, ratio = lasting(word, op, known, trusted_least)
    return always + passing(shape, ratio, votes, hint)


def damage(words: list[str], rng: random.Random) -> list[tuple[str, str]]:
    """(printed, read) of each word of a page that was scanned badly: a few confusions of its own, some stray signs."""
    page = rng.sample(CONFUSIONS, rng.randint(1, 4))
    rate, stray = rng.choice([0.05, 0.15, 0.4]), rng.choice([0.0, 0.01, 0.05])
    out = []
    for w in words:
        read = w
        for printed, seen in page:
            at = read.find(printed)
            if at >= 0 and rng.random() < rate:
                read = read[:at] + seen + read[at + len(printed) :]
        if len(read) > 3 and rng.random() < stray:
            at = rng.randint(1, len(read) - 1)
            read = read[:at] + rng.choice(STRAY[:4]) + read[at:]
        out.append((w, read))
    return out


def train(pages: list[str], known: dict[str, int], trusted_least: int) -> dict[str, dict[str, float]]:
    """Weights of the editor. Half of the pages are damaged; on the others every edit is wrong."""
    rng = random.Random(SEED)
    model = Perceptron()
    examples = []
    for page in pages:
        words = [c for c in map(core, page.split()) if len(c) > 2 and _LETTERS.search(c) and not _CODE.match(c)]
        bad = rng.random() < 0.5
        pairs = damage(words, rng) if bad else [(w, w) for w in words]
        cases = []
        for printed, read in pairs:
            ops = operations(read, known, RATIO * known.get(read, 0) if read in known else trusted_least)
            if ops:
                cases.append((printed, read, ops))
        votes = Counter(w for _, _, ops in cases for w in {o[1] for o in ops})
        examples += [(printed, read, [(o, features(read, o, known, trusted_least, votes[o[1]], bad and rng.random() < 0.9 or rng.random() < 0.1)) for o in ops]) for printed, read, ops in cases]
        if len(examples) > TRAINING_WORDS:
            break
    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for printed, read, ops in examples:
            best, feats = max(((o, f) for o, f in ops), key=lambda x: model.score(x[0][0], x[1]))
            # Keeping the word scores 0.
            edit = model.score(best[0], feats) > 0
            right = best[3] == printed
            if edit and not right:
                model.update(best[0], feats, -1.0)
            if printed != read and not (edit and right):
                for o, f in ops:
                    if o[3] == printed:
                        model.update(o[0], f, 1.0)
                        break
            model.tick()
    joins = join_examples(pages, known, rng)
    for _ in range(EPOCHS):
        rng.shuffle(joins)
        for feats, right in joins:
            if (model.score("join", feats) > 0) != right:
                model.update("join", feats, 1.0 if right else -1.0)
            model.tick()
    return model.averaged()


def end_state(left: str, mark: str, right: str, known: dict[str, int]) -> tuple | None:
    """What the features of a line end are made of; None where nothing can be joined."""
    a, b = left.lstrip(_OPEN + _EDGE), core(right)
    if len(a) < 2 or not a.isalpha() and any(c.isdigit() for c in a) or a.isupper() or not a[-1].isalpha() or not b:
        return None
    joined, compound = a + b, f"{a}-{b}"
    whole = known.get(joined, 0) or known.get(joined[:1].lower() + joined[1:], 0)
    kept = known.get(compound, 0)
    # A small letter at the start may be misread or wrongly decoded.
    first = "small" if b[0].islower() else "odd" if right[0] in "I01!$(|" or not right[0].isascii() else "other"
    state = f"{int(a in known)}{int(b in known)}"
    more = "tie" if not whole and not kept else "whole" if whole >= kept else "kept"
    near = "" if whole or kept else str(int(bool(operations(joined, known))))
    after = int(right[:1] in "-‐")
    words = int(a.isalpha() and b.isalpha())
    sign = "soft" if mark in "\xad¬" else "dash" if mark in "—–~" else "plain"
    return more, first, state, near, sign, words, after, int(compound[:-1] in known), min(len(a), 6)


def end_features(more: str, first: str, state: str, near: str, sign: str, words: int, after: int, cut: int, size: int) -> list[str]:
    return ["e", f"e:{more}", f"e:{more} {first}", f"e:{more} {state} {near}", f"e:{more} {sign} {words}", f"e:{more} {first} {sign} {near}", f"e:after {after} {cut}", f"e:{more} {after}", f"e:{first} {state} {sign}", f"e:len {size} {more}"]


def line_end(left: str, mark: str, right: str, known: dict[str, int]) -> list[str]:
    """Features of joining the word before a hyphen at a line end with the first word of the next line; [] where nothing
    can be joined."""
    state = end_state(left, mark, right, known)
    return end_features(*state) if state else []


def blank(x: str, y: str, known: dict[str, int]) -> list[str]:
    """Features of joining two words over a blank."""
    n, m = known.get(x, 0), known.get(y, 0)
    whole = known.get(x + y, 0)
    ratio = _bucket(whole / (min(n, m) + 1))
    return ["b", f"b:{int(n > 0)}{int(m > 0)}", f"b:r {ratio}", f"b:r {ratio} {int(n > 0)}{int(m > 0)}", f"b:len {min(len(x), 4)} {min(len(y), 4)}", f"b:w {_bucket(whole)}"]


def join_examples(pages: list[str], known: dict[str, int], rng: random.Random) -> list[tuple[list[str], bool]]:
    """(features, whether to join) from clean pages: words cut at random are to be joined; compounds at their own hyphen,
    suspended hyphens, dashes and neighbouring words are not."""
    out: list[tuple[list[str], bool]] = []
    for page in pages:
        tokens = page.split()
        for i, token in enumerate(tokens):
            word, after = core(token), tokens[i + 1] if i + 1 < len(tokens) else ""
            parts = re.split(r"[-‐‑–]", word)
            if len(parts) == 2 and all(parts):
                out.append((line_end(parts[0], "-", parts[1], known), False))
            if after and token[-1] in "-‐–—" and len(token) > 2:
                out.append((line_end(token[:-1], token[-1], after, known), False))
            if word.isalpha() and len(word) > 4 and rng.random() < 0.15:
                at = rng.randint(2, len(word) - 2)
                out.append((line_end(word[:at], rng.choice("-----‐­¬—~"), word[at:] + token[len(token.rstrip(_EDGE)) :], known), True))
                if word in known:
                    out.append((blank(word[:at], word[at:], known), True))
            if after and word.isalpha() and known.get(word + core(after), 0):
                out.append((blank(word, core(after), known), False))
        if len(out) > TRAINING_WORDS:
            break
    return [(f, right) for f, right in out if f]


# ---------------------------------------------------------------- furniture

_FOLD_MANY = [("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"), ("li", "h")]
_FOLD_ONE, _FOLD_AWAY = bytes.maketrans(b"c(1!ltf|0aq$59b8", b"eeiiiiiiooossghh"), b"~'.`,"
_DIGIT = re.compile(r"\d")
# A digit comes first, so that the search skips to digits.
_APART = re.compile(r"\d(?<![^\W\d_]\d)\d*(?![^\W\d_])")
_PAGE = [
    re.compile(r"^\[\s*([\dlIOSoBi!|$]{1,5})\s*\]$"),
    re.compile(r"^([\dlIOSo!|$]{1,5})\s*/\s*[\dlIOSo!|$]{1,5}$"),
    re.compile(r"^p\s*[.,]?\s*([\dlIOSo!|$]{1,5})$", re.I),
    re.compile(r"^(?:page|seite|pagina|página|pag\.?|s\.|folio)\s*([\dlIOSo!|$]{1,5})(?:\s*\w{2,3}\s*[\dlIOSo!|$]{1,5})?$", re.I),
    re.compile(r"^[-–—~]\s*([\dlIOSo!|$]{1,5})\s*[-–—~]$"),
]
_DIGITS = str.maketrans("lIOSo!|$Bi", "1105011581")
_ROMAN = re.compile(r"^(?=[ivxlIl!1|]{1,7}$)x{0,3}(?:[i1l!I|]x|[i1l!I|]v|v?[i1l!I|]{0,3})$")
_ROMAN_VALUE = {"i": 1, "v": 5, "x": 10}


#: Characters at the beginning of a line by which inner lines are counted.
HEAD = 20


def folded_lines(lines: list[str]) -> list[bytes]:
    """The shapes of lines, under which all their misreadings fall together; numbers become #. They are folded in one
    text: no rule reaches over a line end."""
    if not lines:
        return []
    s = "\n".join([" ".join(x.split()) for x in lines]).lower()
    made = _APART.sub("#", s).encode("utf-8", "surrogatepass")
    for many, one in _FOLD_MANY:
        made = made.replace(many.encode(), one.encode())
    return made.translate(_FOLD_ONE, _FOLD_AWAY).split(b"\n")


def folded_line(line: str) -> bytes:
    return folded_lines([line])[0]


def folded_heads(lines: list[str]) -> list[bytes]:
    """The shapes of the lines' beginnings: lines that break at other places still share them."""
    return [x[:HEAD] for x in folded_lines([x[: HEAD + 8] for x in lines])]


def folded_head(line: str) -> bytes:
    return folded_heads([line])[0]


def _value(digits: str) -> int:
    made = digits.translate(_DIGITS)
    return int(made) if made.isdigit() else -1


def _roman(line: str) -> int:
    if not _ROMAN.match(line):
        return -1
    values = [_ROMAN_VALUE.get(c, 1) for c in line]
    return sum(-v if v < max(values[i:]) else v for i, v in enumerate(values))


def page_number(line: str, page_num: int) -> tuple[int, bool]:
    """(offset of a printed number from the place of the page, whether its form alone tells it is one); offset -99 if none."""
    if len(line) > 24:
        return -99, False
    for form in _PAGE:
        m = form.match(line)
        if m:
            v = _value(m.group(1))
            return (v - page_num if v >= 0 else -99), True
    if re.fullmatch(r"[\dlIOSo!|$]{1,5}", line) and (any(c.isdigit() for c in line) or _roman(line) == page_num + 1):
        v = _value(line)
        if any(c.isdigit() for c in line) and v >= 0:
            return v - page_num, False
    r = _roman(line)
    if r > 0:
        return r - page_num, False
    return -99, False


def edges(lines: list[str]) -> list[tuple[int, int]]:
    """(line, position) of the first two and last two lines that aren't blank; positions 0, 1, -2, -1."""
    first, last = [], []
    for some, order in ((first, range(len(lines))), (last, range(len(lines) - 1, -1, -1))):
        for i in order:
            if lines[i].strip():
                some.append(i)
                if len(some) == 2:
                    break
    if not first:
        return []
    if len(first) < 2 or first[1] >= last[1]:
        return [(first[0], 0)] + ([(last[0], -1)] if last[0] != first[0] else [])
    return [(first[0], 0), (first[1], 1), (last[1], -2), (last[0], -1)]


def split_running(line: str, page_num: int = 0) -> tuple[str, str]:
    """(line without a page number set apart at its end or start, that number or '')."""
    line = line.strip()
    if "  " not in line or len(line) > 2 * LONGEST:
        return line, ""
    parts = re.split(r"\s{2,}", line)
    for number, rest in ((parts[-1], parts[:-1]), (parts[0], parts[1:])):
        offset, sure = page_number(number, page_num)
        if sure or offset == 1 or re.fullmatch(r"[\dlIOSo!|$]{1,5}", number) and _DIGIT.search(number):
            return "    ".join(rest), number
    return line, ""



def headlike(line: str) -> bool:
    """Whether a line can be a header or footer: it has a word, and isn't the end of a sentence."""
    return _FOUR_LETTERS.match(line) is not None and not (line[:1].islower() and line[-1:] in ".!?")


def furniture_lines(lines: list[str], page_num: int, furniture: set[int], offsets: set[int]) -> dict[int, set[str]]:
    """Lines of the page that are furniture, each with what it is: header, page_number, or both.

    The second line from an edge counts only where the line outside it is furniture too.
    """
    out: dict[int, set[str]] = {}
    spots = edges(lines)
    at = {pos: i for i, pos in spots}
    for pos, outer in ((0, None), (-1, None), (1, 0), (-2, -1)):
        i = at.get(pos)
        if i is None or i in out or outer is not None and at.get(outer) not in out:
            continue
        line = lines[i].strip()
        offset, sure = page_number(line, page_num)
        if offset != -99 or sure:
            digits = _DIGIT.search(line) is not None
            # A bare number at the very edge is a page's unless it ends a column of numbers.
            beside = lines[at[{0: 1, -1: -2}[pos]]].strip() if outer is None and {0: 1, -1: -2}[pos] in at else ""
            alone = outer is None and digits and beside and not re.fullmatch(r"[\d.,\s%]+", beside)
            # '14!' at the foot is the end of a sentence.
            alone = alone and line[-1] != "!"
            if sure or offset == 1 or digits and (alone or offset in offsets):
                out[i] = {"page_number"}
                continue
        rest, number = split_running(line, page_num)
        value = page_number(number, page_num)[0] if number else -99
        if furniture and len(line) <= LONGEST and headlike(rest) and line_key(rest) in furniture:
            out[i] = {"header"} | ({"page_number"} if number else set())
        elif number and len(line) <= LONGEST and (outer is None or value == 1 or value in offsets) and re.search(r"[^\W\d_]{2}.*\s{3,}\S+$|^\S+\s{3,}.*[^\W\d_]{2}", line):
            out[i] = {"header", "page_number"}
    return out


def _key(shape: bytes) -> int:
    return xxhash.xxh3_64_intdigest(shape) - (1 << 63)


def line_key(line: str) -> int:
    return _key(folded_line(line))


_CUT = re.compile(r"(\S*[^\W\d_])([-‐‑¬\xad—–~])[.,'|~]?$")
#: Where a line of a text may end with a hyphen, to its line end.
_HYPHEN_END = re.compile(r"[-‐‑¬\xad—–~][.,'|~]?[^\S\n]*+\n")


def _cut(end: str) -> re.Match | None:
    """The last word of a line and its hyphen, if it ends with one."""
    return _CUT.search(end.rsplit(None, 1)[-1]) if end and (end[-1] in HYPHENS or end[-2:-1] and end[-2:-1] in HYPHENS) else None


def trusted_words(known: dict[str, int]) -> set[str]:
    """Known words that no single edit turns into a word that is RATIO times as frequent."""
    return {w for w, n in known.items() if not operations(w, known, RATIO * n)}


class Layered:
    """Counts of words: those that all tasks hold, and those that a page has got."""

    def __init__(self, base: dict[str, int], more: dict[str, int]) -> None:
        self.base, self.more = base, more

    def get(self, word: str, default: int = 0) -> int:
        n = self.base.get(word)
        return self.more.get(word, default) if n is None else n

    def __contains__(self, word: str) -> bool:
        return word in self.base or word in self.more


class Asking:
    """Stands in for the counts of words and notes which others than those held would be looked up, as far as a bitmap of
    the rarer words lets it: where words share a bit more are asked for than there are, never fewer."""

    def __init__(self, base: dict[str, int], bitmap: bytes) -> None:
        self.base, self.bitmap, self.asked = base, bitmap, set()

    def maybe(self, word: str) -> bool:
        at = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) & ((1 << BITS) - 1)
        return bool(self.bitmap[at >> 3] >> (at & 7) & 1)

    def get(self, word: str, default: int = 0) -> int:
        n = self.base.get(word)
        if n is not None:
            return n
        if self.maybe(word):
            self.asked.add(word)
        return default

    def __contains__(self, word: str) -> bool:
        return self.get(word, 0) > 0


class Asker:
    """The rarer words whose counts a page needs, each with the word of the page it is needed for ('' for line ends)."""

    def __init__(self, known: dict[str, int], bitmap: bytes, trusted: set[str]) -> None:
        self.known, self.trusted = known, trusted
        self.counts = Asking(known, bitmap)
        self.seen: dict[str, tuple[str, frozenset[str], bool]] = {}
        #: Trusted words, and tokens that ask for nothing.
        self.idle = set(trusted)

    def _of(self, token: str) -> tuple[str, frozenset[str]]:
        counts = self.counts
        counts.asked.clear()
        c = standing(token, counts)
        # A rarer word is never RATIO times as frequent as one that all tasks hold.
        if len(c) < 2 or c in self.known or _CODE.match(c) or not _LETTERS.search(c):
            return c, frozenset()
        ops = operations(c, counts, TRUSTED_LEAST)
        wanted = set(counts.asked)
        return c, frozenset(wanted | ({c} if (ops or wanted) and counts.maybe(c) else set()))

    def page(self, text: str) -> set[tuple[str, str]]:
        counts, known, out = self.counts, self.known, set()
        tokens = text.split()
        alone = set()
        for token in set(tokens) - self.idle:
            found = self.seen.get(token)
            if found is None:
                bare = core(token)
                c, wanted = (bare, frozenset()) if bare in self.trusted else self._of(token)
                found = (c, wanted, len(c) > 1 and c not in known and c.isalpha())
                if len(self.seen) + len(self.idle) >= Editor.REMEMBERED + len(self.trusted):
                    self.seen.clear()
                    self.idle = set(self.trusted)
                if wanted or found[2]:
                    self.seen[token] = found
                else:
                    self.idle.add(token)
            c, wanted, lone = found
            for w in wanted:
                out.add((c, w))
            if lone:
                alone.add(token)
        for j in [j for j, token in enumerate(tokens) if token in alone] if alone else ():
            for a, b in ((j, j + 1), (j - 1, j)):
                if 0 <= a and b < len(tokens):
                    x, y = tokens[a].lstrip(_OPEN), core(tokens[b])
                    if x.isalpha() and y.isalpha() and (x + y in known or counts.maybe(x + y)):
                        out.update(("", w) for w in (x, y, x + y) if w not in known and counts.maybe(w))
        for found in _HYPHEN_END.finditer(text):
            m = _cut(text[text.rfind("\n", 0, found.start()) + 1 : found.end()].rstrip())
            stop = text.find("\n", found.end())
            after = text[found.end() : stop if stop >= 0 else None].split(None, 1) if m else None
            if after:
                counts.asked.clear()
                end_state(m.group(1), m.group(2), after[0], counts)
                out.update(("", w) for w in counts.asked)
        return out


class Editor:
    """Judges one page at a time; holds what all pages share."""

    #: Words whose edits are remembered, at most.
    REMEMBERED = 200_000

    def __init__(self, known: dict[str, int], trusted_least: int, weights: dict[str, dict[str, float]], trusted: set[str] | None = None) -> None:
        self.known, self.least = known, trusted_least
        self.weights = weights
        self.trusted = trusted_words(known) if trusted is None else trusted
        self.seen: dict[str, tuple[str, list]] = {}
        #: Trusted words, and tokens that are neither edited nor joined whatever counts a page has got.
        self.plain = set(self.trusted)
        #: Scores of the parts that take few values: line ends, and what an edit has from its page.
        self.ends: dict[tuple, float] = {}
        self.passed: dict[tuple, float] = {}

    def _good(self, kind: str, feats: list[str]) -> float:
        w = self.weights.get(kind)
        return sum([w.get(f, 0.0) for f in feats]) if w else 0.0

    def _end(self, left: str, mark: str, right: str, known) -> float:
        state = end_state(left, mark, right, known)
        if state is None:
            return 0.0
        score = self.ends.get(state)
        if score is None:
            score = self.ends[state] = self._good("join", end_features(*state))
        return score

    def _passing(self, kind: str, shape: str, ratio: str, votes: int, hint: bool) -> float:
        at = kind, shape, ratio, min(votes, 5), hint
        score = self.passed.get(at)
        if score is None:
            score = self.passed[at] = self._good(kind, passing(shape, ratio, votes, hint))
        return score

    def _ops(self, token: str, known) -> tuple[str, list]:
        """(word of the token, its edits with the page-independent part of their score)."""
        c = standing(token, known)
        if len(c) < 2 or _CODE.match(c) or not _LETTERS.search(c):
            return c, []
        n = known.get(c, 0)
        out = []
        for o in operations(c, known, RATIO * n if n else self.least):
            always, shape, ratio = lasting(c, o, known, self.least)
            out.append((o, self._good(o[0], always), shape, ratio))
        return c, out

    def edits(self, lines: list[str], skip: set[int], loose: set[tuple[int, int]], hint: bool, known=None, touched: frozenset[str] | set[str] = frozenset()) -> tuple[dict[tuple[int, int], str], set[tuple[int, int]]]:
        """({(line, token): repaired word}, tokens to join with the next one)."""
        trusted, seen, plain = self.trusted, self.seen, self.plain
        known = self.known if known is None else known
        cases, joins = [], set()
        for i, line in enumerate(lines):
            if i in skip:
                continue
            tokens = line.split()
            if plain.issuperset(tokens):
                continue
            for j, token in enumerate(tokens):
                if token in plain or (i, j) in loose:
                    continue
                found = seen.get(token)
                if found is None:
                    sure = (bare := core(token)) in trusted
                    c, ops = found = (bare, []) if sure else self._ops(token, self.known)
                    if len(seen) + len(plain) >= self.REMEMBERED + len(trusted):
                        seen.clear()
                        plain = self.plain = set(trusted)
                    # Pages get no counts for words that all tasks hold, nor for codes and signs.
                    if not ops and (sure or c in self.known or len(c) < 2 or not c.isalpha() and (_CODE.match(c) or not _LETTERS.search(c))):
                        plain.add(token)
                        continue
                    seen[token] = found
                c, ops = found
                if c in touched:
                    c, ops = self._ops(token, known)
                if ops:
                    cases.append((i, j, c, ops))
                elif len(c) > 1 and c.isalpha() and c not in known:
                    for a, b, at in ((j, j + 1, j), (j - 1, j, j - 1)):
                        if 0 <= a and b < len(tokens) and (i, at) not in joins and (i, a) not in loose and (i, b) not in loose:
                            x, y = tokens[a].lstrip(_OPEN), core(tokens[b])
                            if x.isalpha() and y.isalpha() and known.get(x + y, 0) > self.least and self._good("join", blank(x, y, known)) > 0:
                                joins.add((i, at))
                                break
        if not cases:
            return {}, joins
        votes = Counter(w for *_, ops in cases for w in {o[0][1] for o in ops})
        # A short word can be another language's; it is edited only as longer words of the page are.
        firm = {w for _, _, c, ops in cases if len(c) > 3 or not c.isalpha() for w in {o[0][1] for o in ops}}
        out = {}
        for i, j, c, ops in cases:
            if len(c) <= 3 and c.isalpha():
                ops = [o for o in ops if o[0][1] in firm and votes[o[0][1]] > 1]
                if not ops:
                    continue
            if (i, j) in joins or (i, j - 1) in joins:
                continue
            best, score = max(((o, base + self._passing(o[0], shape, ratio, votes[o[1]], hint)) for o, base, shape, ratio in ops), key=lambda x: x[1])
            if score > 0:
                out[(i, j)] = best[3]
        return out, joins

    def page(self, text: str, page_num: int, furniture: set[int], offsets: set[int], hint: bool, want_text: bool, more: list[tuple[str, str, int]] | None = None) -> tuple[list[str], str | None]:
        """(kinds of defect, repaired text) of a page; a page without words has no defect and keeps its text. ``more`` has the
        counts of rarer words (word of the page, word, count)."""
        known = Layered(self.known, {w: n for _, w, n in more}) if more else self.known
        touched = {c for c, _, _ in more} if more else frozenset()
        lines = text.split("\n")
        out = furniture_lines(lines, page_num, furniture, offsets)
        defects = set().union(*out.values()) if out else set()
        skip = set(out)
        loose: set[tuple[int, int]] = set()
        cuts = set()
        i = at = 0
        for found in _HYPHEN_END.finditer(text):
            i += text.count("\n", at, found.start())
            at = found.start()
            if i in skip or i + 1 in skip:
                continue
            m = _cut(lines[i].rstrip())
            if m:
                after = lines[i + 1].split(None, 1)
                before = lines[i].split()
                if after and self._end(m.group(1), m.group(2), after[0], known) > 0:
                    cuts.add(i)
                loose |= {(i, len(before) - 1), (i + 1, 0)}
        if cuts:
            defects.add("hyphen")
        words, joins = self.edits(lines, skip, loose, hint, known, touched)
        if words or joins:
            defects.add("char")
        return sorted(defects), self._paragraphs(lines, skip, cuts, words, joins, known) if want_text else None

    def _paragraphs(self, lines, skip, cuts, words, joins, known) -> str:
        """Lines of running text put together into paragraphs; blank lines, lists, tables and headings stay apart."""
        made, open_line = [], ""
        width = max((len(x) for i, x in enumerate(lines) if i not in skip), default=0)
        for i, line in enumerate(lines):
            if i in skip:
                continue
            tokens = line.split()
            fixed, glue = [], False
            for j, token in enumerate(tokens):
                new = words.get((i, j))
                token = token.replace(standing(token, known), new, 1) if new is not None else token
                if glue:
                    fixed[-1] += token
                else:
                    fixed.append(token)
                glue = (i, j) in joins
            now = line if not words and not joins and len(fixed) == len(tokens) and not open_line else " ".join(fixed)
            if not tokens:
                if open_line:
                    made.append(open_line)
                    open_line = ""
                if made and made[-1]:
                    made.append("")
                continue
            now = f"{open_line}{now.lstrip()}" if open_line and open_line.endswith("\0") else f"{open_line} {now.lstrip()}" if open_line else now
            now = now.replace("\0", "")
            if i in cuts:
                open_line = _CUT.sub(r"\1", now.rstrip()) + "\0"
            elif self._runs_on(line, lines, i, skip, width):
                open_line = now
            else:
                made.append(now)
                open_line = ""
        if open_line:
            made.append(open_line.replace("\0", ""))
        return re.sub(r"\n{3,}", "\n\n", "\n".join(made)).strip("\n")

    @staticmethod
    def _runs_on(line, lines, i, skip, width) -> bool:
        after = next((lines[k] for k in range(i + 1, len(lines)) if k not in skip), "")
        if not after.strip() or re.match(r"\s*(?:[-•*–]\s|\d+[.)]\s|\|)", after) or re.match(r"\s*(?:[-•*–]\s|\|)", line) and len(line) < 0.6 * width:
            return False
        return len(line.rstrip()) >= 0.6 * width and not re.fullmatch(r"[\d\s.,%/|A-Z-]+", line)


# ---------------------------------------------------------------- over a corpus


def _survey(pages: DataFrame) -> DataFrame:
    """One pass: counts of words, edge lines by file and page, inner lines, and offsets of printed numbers.

    Rows (kind, file, word, h, page, n, row, spot): 'w' a word; 'e' an edge line, its beginning in n, its last character in word; 'm' the beginning of
    an inner line in h; 'o' an offset in h.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        inner: Counter = Counter()
        for b in batches:
            edge, rests, rows, inside = [], [], [], []
            found = pc.utf8_split_whitespace(pa.array(b["t"], pa.large_string())).flatten().value_counts()
            words.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist())))
            for f, n, t, r in zip(b["f"], b["n"], b["t"], b["r"]):
                lines = t.split("\n")
                spots = dict(edges(lines))
                for i, spot in spots.items():
                    line = lines[i].strip()
                    rest, number = split_running(line, n)
                    if len(line) <= LONGEST and headlike(rest):
                        edge.append((f, n, r, spot))
                        rests.append(rest)
                    offset, sure = page_number(line, n)
                    offset = page_number(number, n)[0] if number else offset if sure else -99
                    if offset != -99:
                        rows.append(("o", f, None, offset, n, 1, r, spot))
                inside += [x for i, x in enumerate(lines) if i not in spots and 0 < len(x.strip()) <= LONGEST]
            inner.update(folded_heads(inside))
            if edge:
                files, places, ids, at = zip(*edge)
                yield pd.DataFrame({"kind": "e", "file": files, "word": [x[-1] for x in rests], "h": list(map(_key, folded_lines(rests))), "page": places, "n": list(map(_key, folded_heads(rests))), "row": ids, "spot": at})
            if rows:
                yield pd.DataFrame(rows, columns=["kind", "file", "word", "h", "page", "n", "row", "spot"])
            if len(words) > 300_000 or len(inner) > 300_000:
                yield from flush(words, inner)
        yield from flush(words, inner)

    def flush(words: Counter, inner: Counter) -> Iterator[pd.DataFrame]:
        cores: Counter = Counter()
        for w, n in words.items():
            c = core(w)
            if len(c) > 1 and _LETTERS.search(c):
                cores[c] += n
        # An empty frame has no types that Arrow could take for those of the schema.
        if cores:
            yield pd.DataFrame({"kind": "w", "file": None, "word": list(cores), "h": None, "page": None, "n": list(cores.values()), "row": None, "spot": None})
        if inner:
            yield pd.DataFrame({"kind": "m", "file": None, "word": None, "h": [_key(x) for x in inner], "page": None, "n": list(inner.values()), "row": None, "spot": None})
        words.clear()
        inner.clear()

    rows = pages.filter(F.length("t") > 0).select("f", "n", "t", "r")
    return rows.mapInPandas(run, "kind string, file long, word string, h long, page int, n long, row long, spot int")


def _inside(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """(f, h, inner): how often the whole lines ``wanted`` (h) stand inside pages, by file.

    Which lines are looked up is shared with the tasks as a bitmap of fixed size: where keys share a bit more lines are
    counted than are asked for, never fewer.
    """
    shared = pages.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap, mask = shared.value, (1 << BITS) - 1
        inner: Counter = Counter()
        for b in batches:
            files, inside = [], []
            for f, n, t in zip(b["f"], b["n"], b["t"]):
                lines = t.split("\n")
                spots = {i for i, _ in edges(lines)}
                some = [x for i, x in enumerate(map(str.strip, lines)) if i not in spots and 0 < len(x) <= LONGEST]
                inside += [split_running(x, n)[0] if "  " in x else x for x in some] if "  " in t else some
                files += [f] * len(some)
            for f, shape in zip(files, folded_lines(inside)):
                at = xxhash.xxh3_64_intdigest(shape) & mask
                if bitmap[at >> 3] >> (at & 7) & 1:
                    inner[f, _key(shape)] += 1
            if len(inner) > 300_000:
                yield flush(inner)
        if inner:
            yield flush(inner)

    def flush(inner: Counter) -> pd.DataFrame:
        out = pd.DataFrame([(f, h, n) for (f, h), n in inner.items()], columns=["f", "h", "n"])
        inner.clear()
        return out

    counted = pages.filter(F.length("t") > 0).select("f", "n", "t").mapInPandas(run, "f long, h long, n long")
    return counted.groupBy("f", "h").agg(F.sum("n").alias("inner"))


def _furniture(survey: DataFrame, pages_of: DataFrame, pages: DataFrame) -> DataFrame:
    """(f, r, furniture, offsets) by row, four of each at most. A file's own furniture is on a tenth of its pages, or at one
    place of 2 pages (3 where it ends like a sentence), however long the file is; what is furniture of several files needs half a percent of the
    pages only. Neither begins as lines inside pages do, unless it has one place on 3 pages and the whole line is hardly
    ever inside, in its file and in all. A printed offset is on a twentieth of the pages, or on 3 pages that are no more than NEAR apart."""
    edge = survey.filter("kind = 'e'").select(F.col("file").alias("f"), "h", "page", F.col("n").alias("head"), F.col("row").alias("r"), "spot", F.col("word").isin(".", "!", "?").alias("stop"))
    # The four spots are bits, so that one row of a page tells all that the line has there.
    on_page = edge.groupBy("f", "h", "head", "page").agg(F.bit_or(F.expr("shiftleft(1, spot & 3)")).alias("spots"), F.max("stop").alias("stop"))
    steady = F.greatest(*[F.count_if(F.col("spots").bitwiseAND(1 << i) > 0) for i in range(4)])
    by_file = materialize(on_page.groupBy("f", "h", "head").agg(F.count("*").alias("n"), F.max("stop").alias("stop"), steady.alias("steady")), "by-file")
    corpus = by_file.groupBy("h").agg(F.sum("n").alias("all"), F.count("*").alias("files"))
    heads = by_file.groupBy("head").agg(F.sum("n").alias("at_edge"))
    inner = survey.filter("kind = 'm'").groupBy(F.col("h").alias("head")).agg(F.sum("n").alias("inner"))
    judged = by_file.join(corpus, "h").filter((F.col("n") >= 2) | (F.col("files") >= 2))
    judged = judged.join(heads, "head").join(inner, "head", "left").join(pages_of, "f").withColumn("inner", F.coalesce("inner", F.lit(0)))
    often = (F.col("n") >= 2) & (F.col("n") >= 0.1 * F.col("pages")) | (F.col("steady") >= F.when(F.col("stop"), 3).otherwise(2))
    judged = materialize(judged, "judged")
    begins = F.col("inner") > 0.2 * F.col("at_edge")
    firm = (F.col("steady") >= 3) & ~F.col("stop") & begins
    inside = materialize(_inside(pages, judged.filter(firm).select("h").distinct()), "inside")
    everywhere = inside.groupBy("h").agg(F.sum("inner").alias("all_inner"))
    judged = judged.join(inside.withColumnRenamed("inner", "file_inner"), ["f", "h"], "left").join(everywhere, "h", "left").fillna(0, ["file_inner", "all_inner"])
    own = often & ~begins | firm & (F.col("file_inner") <= 0.2 * F.col("n")) & (F.col("all_inner") <= 0.2 * F.col("all"))
    shared = (F.col("files") >= 2) & (F.col("all") >= 4) & (F.col("inner") <= 0.05 * F.col("at_edge")) & (F.col("n") >= 0.005 * F.col("pages"))
    kept = judged.filter(own | shared).select("f", "h").distinct()
    lines = edge.join(kept, ["f", "h"]).groupBy("f", "r").agg(F.collect_set("h").alias("furniture"))
    seen = survey.filter("kind = 'o'").filter(F.abs("h") < 100_000).select(F.col("file").alias("f"), "h", "page", F.col("row").alias("r"))
    near = Window.partitionBy("f", "h").orderBy("page")
    places = seen.select("f", "h", "page").distinct()
    places = places.withColumn("n", F.count("*").over(Window.partitionBy("f", "h"))).withColumn("beside", sum(F.when(F.abs(step(F.col("page"), by).over(near) - F.col("page")) <= NEAR, 1).otherwise(0) for step in (F.lag, F.lead) for by in (1, 2)))
    offset = places.join(pages_of, "f").filter((F.col("n") >= 2) & (F.col("n") >= 0.05 * F.col("pages")) | (F.col("beside") >= 2)).select("f", "h", "page")
    offsets = seen.join(offset, ["f", "h", "page"]).groupBy("f", "r").agg(F.collect_set("h").alias("offsets"))
    return lines.join(offsets, ["f", "r"], "full")


def _bitmap(hashed: DataFrame) -> bytes:
    """A bitmap of fixed size of the low bits of the longs ``h``."""
    bit = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1))
    made = np.zeros(1 << BITS - 6, dtype="<i8")
    for w in hashed.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS INT))")).alias("bits")).collect():
        made[w["at"]] = w["bits"]
    return made.tobytes()


def _rarer(pages: DataFrame, counts: DataFrame, shared) -> DataFrame:
    """(r, more): the counts of rarer words that each page needs. ``counts`` has word and n of words that not all tasks
    hold; ``shared`` is the broadcast editor."""
    bitmap = pages.sparkSession.sparkContext.broadcast(_bitmap(counts.select(F.xxhash64("word").alias("h"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asker = Asker(shared.value.known, bitmap.value, shared.value.trusted)
        for b in batches:
            rows = [(r, c, w) for r, t in zip(b["r"], b["t"]) for c, w in asker.page(t)]
            if rows:
                yield pd.DataFrame(rows, columns=["r", "c", "word"])

    asked = pages.select("r", "t").mapInPandas(run, "r long, c string, word string")
    return asked.join(counts, "word").groupBy("r").agg(F.collect_list(F.struct("c", "word", "n")).alias("more"))


def repaired(pages: DataFrame, key: str, file: str, page_num: str, text: str, needs_ocr: str, want_text: bool = True) -> DataFrame:
    """(key, defects, repaired): the kinds of scan noise on each page and, if wanted, its text without them.

    Null and blank texts have no defects and stay as they are; every copy of a page is judged. A null page number counts
    as -1, a null file as a file of its own kind. ``needs_ocr`` is a hint among the features, no more. Shared with all
    tasks are the words on at least TRUSTED_SHARE of the pages (a bounded number) and the editor's weights; the counts of
    rarer words reach the pages that need them by a join, so a word is known from TRUSTED_LEAST occurrences at any size.
    """
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("k"), F.coalesce(F.col(file), F.lit(-1)).cast("long").alias("f"), F.coalesce(F.col(page_num), F.lit(-1)).cast("int").alias("n"), F.col(text).alias("t"), F.coalesce(F.col(needs_ocr), F.lit(False)).alias("hint"), F.xxhash64(F.col(key)).alias("r"))
    full = rows.filter(F.length(F.trim("t")) > 0)
    survey = materialize(_survey(full), "survey")
    pages_of = materialize(full.groupBy("f").agg(F.count_distinct("n").alias("pages"), F.count("*").alias("copies")), "pages-of")
    total = pages_of.agg(F.sum("copies")).first()[0] or 0
    sent = max(TRUSTED_LEAST, int(TRUSTED_SHARE * total))
    counts = survey.filter("kind = 'w'").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= TRUSTED_LEAST)
    counts = materialize(counts, "counts") if sent > TRUSTED_LEAST else counts
    known = {r.word: r.n for r in counts.filter(F.col("n") >= sent).collect()}
    clean = full.filter(~F.col("hint")).orderBy(F.xxhash64("k"), "k").limit(TRAINING_PAGES).select("t")
    weights = train([r.t for r in clean.collect()], known, TRUSTED_LEAST)
    # What an editor remembers of words lasts as long as the Python process, over all its tasks.
    shared = pages.sparkSession.sparkContext.broadcast(Editor(known, TRUSTED_LEAST, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        editor = shared.value
        for b in batches:
            done = [editor.page(t, n, set(u.tolist()) if u is not None else set(), set(o.tolist()) if o is not None else set(), h, want_text, [(x["c"], x["word"], x["n"]) for x in m] if m is not None else None) for t, n, u, o, h, m in zip(b["t"], b["n"], b["furniture"], b["offsets"], b["hint"], b["more"])]
            yield pd.DataFrame({key: b["k"], "defects": [d for d, _ in done], "repaired": pd.Series([x for _, x in done], dtype="object")})

    joined = full.join(_furniture(survey, pages_of, full), ["f", "r"], "left")
    # With few pages all known words are sent, and nothing is left to ask for.
    if sent > TRUSTED_LEAST:
        joined = joined.join(materialize(_rarer(full, counts.filter(F.col("n") < sent), shared), "rarer"), "r", "left")
    else:
        joined = joined.withColumn("more", F.lit(None).cast("array<struct<c: string, word: string, n: bigint>>"))
    blank = rows.filter(F.col("t").isNull() | (F.length(F.trim("t")) == 0)).select(F.col("k").alias(key), F.array().cast("array<string>").alias("defects"), F.col("t").alias("repaired"))
    return joined.select("k", "n", "t", "hint", "furniture", "offsets", "more").mapInPandas(run, f"`{key}` {kind}, defects array<string>, repaired string").unionByName(blank)

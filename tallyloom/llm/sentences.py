"""Sentence units of texts in any language and script.

Method: document-centred disambiguation. A full stop is ambiguous; other places in the text are not. A
word whose stop is followed by a small letter is an abbreviation; one whose stop ends a paragraph can
end a sentence; a word that begins a paragraph can begin a sentence. What the document itself shows
decides first. Where it shows nothing, the same evidence counted over the whole corpus decides, and
last a short list of common abbreviations. Marks of scripts that have their own full stop need no such
evidence: they end a sentence by themselves, and there a Latin stop after a short word is an abbreviation.

The texts are read once. The scan lays down for each text the places where a sentence can end, those that
need no evidence as they are and the open ones with what stands around them: the word before, the next word, and a few
flags. This table is a small part of the texts. The evidence is an aggregate over it, and a second pass over it, without the texts,
closes the open places.

Verdicts of the corpus are shares of a key's own occurrences, so that ten times the same texts are split like the texts
themselves. One needs more: that a word is an abbreviation before names ("Capt. Velkin") shows only in its never ending a
paragraph, and is held for true when that is ``ODDS`` times likelier for an abbreviation than for any other word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE_SPACE
from ..session import materialize, ship

BROADCAST_KEYS = 100_000

# Marks, by script.
HARD = "。｡．？！।॥؟۔։።፧፨។៕။꓿︒﹖﹗‼⁇⁈⁉"
SOFT = ".!?…"
CLOSERS = "\"'”’»›)]}）］｝」』】》〉〕〗〙〛｣"
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "「": "」", "『": "』", "【": "】", "《": "》", "〈": "〉", "〔": "〕", "｢": "｣", "«": "»", "‹": "›"}
OPENERS = "\"“„‚‘'«‹([{（［「『【《〈〔｢¿¡"
QUOTES = "\"“„«‹「『｢”»›」』｣"
NARROW = " \xa0\u2009\u202f"
INTRODUCES = ":：,，、"

# Common abbreviations, words before a letter or an ordinal, and months. They count only where neither the document nor the corpus
# shows how a word is used.
BEFORE_NAMES = {"dr", "prof", "mr", "mrs", "ms", "st", "sr", "sra", "mme", "suppl", "vs", "cf", "vgl", "viz", "incl", "bzw", "approx", "ca", "env", "circa", "e.g", "i.e", "v", "г-н", "акад"}
BEFORE_NUMBERS = {"no", "nos", "nr", "fig", "figs", "sec", "eq", "eqs", "ch", "vol", "pp", "ref", "refs", "tab", "abb", "kap", "art", "núm", "рис", "табл", "см", "стр", "al", "ed", "eds"}
MAY_END = {"etc", "inc", "ltd", "corp", "co", "jr", "usw", "min", "h", "hr", "hrs", "a.m", "p.m", "aprox", "др", "пр", "т", "г", "гг", "sp", "spp", "u.s"}
LETTER_NOUNS = {"plan", "vitamin", "group", "type", "class", "option", "hepatitis", "panel", "lane", "grade", "phase", "appendix"}
GERMAN_BEFORE_ORDINAL = {"am", "vom", "zum", "beim", "im", "der", "die", "das", "dem", "den", "des", "bis", "seit", "ab", "jeden"}
MONTHS = {"januar", "jänner", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"}

_NL = r"(?:\r\n|\r(?!\n)|(?<!\r)\n|[\x85\u2028\u2029])"
_SPACE = r"[^\S\n\r\x85\u2028\u2029]"
_BLANK = re.compile(rf"{_NL}{_SPACE}*{_NL}")
_BLANK_SIMPLE = re.compile(rf"[\n\x85\u2028\u2029]{_SPACE}*[\n\x85\u2028\u2029]")  # the same for texts without carriage returns
_ITEM = rf"{_SPACE}*(?:([-*•])|(\d{{1,4}})[.)])(?={_SPACE}+\S)"
_FIRST_LINE = re.compile(_ITEM)
_LATER_LINE = re.compile(rf"[\n\r\x85\u2028\u2029]{_ITEM}")
_MARKS = re.compile(rf"[{re.escape(SOFT + HARD)}]+")
_PAIRED = re.compile("[" + re.escape("".join(PAIRS) + "".join(PAIRS.values()) + "„“”\"") + "]")
_NOTE = re.compile(r"[\[［]\d{1,4}(?:[,–-]\d{1,4})*[\]］]")
_THAI = re.compile(rf"(?<=[\u0e00-\u0e7f]){_SPACE}+(?=[\u0e00-\u0e7f])")
_WORD = re.compile(r"[^\W_](?:[^\W_]|[-'’\xad](?=[^\W_]))*")
_CHUNK_EDGE = "\"“”„‚‘’'«»‹›()[]{}（）「」『』【】—–-¿¡*#"
_DEVANAGARI = re.compile(r"[ऀ-ॿ]")
_LETTERS = re.compile(r"[^\W\d_][^\d_/@]*\Z")  # numbers, file names and the like are no abbreviations
_BARE = re.compile(r" \d{1,2}(?=[\s,;:])")
_ABBREVIATION = r"^[\p{L}\p{M}]+([.'’-][\p{L}\p{M}]+)*$"
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_/\\@")  # no stop before one of these ends anything
_LEADS = frozenset(OPENERS + "—–-")
_FREE = "\"“„«‹([{¿¡ "
SHORT_WORD = 6
LONGEST = 200  # characters without a space that can be a word


def _is_caseless(ch: str) -> bool:
    return ch.isalpha() and not ch.isupper() and not ch.islower() and not ch.istitle()


# ---------------------------------------------------------------- units


def units(text: str) -> list[tuple[int, int, int, bool, bool]]:
    """Parts that no sentence crosses: (start, first character after a list mark, end, begins a paragraph, ends with a blank line)."""
    found, a = [], 0
    blocks = []
    for m in (_BLANK if "\r" in text else _BLANK_SIMPLE).finditer(text):
        blocks.append((a, m.start(), True))
        a = m.end()
    blocks.append((a, len(text), False))
    for a, b, blank in blocks:
        cuts: list[tuple[int, int]] = []  # start of a list item, end of its mark
        last = None
        head = _FIRST_LINE.match(text, a, b)
        for m in chain((head,) if head else (), _LATER_LINE.finditer(text, a, b)):
            at = m.start(1) if m.group(1) else m.start(2)
            if m.group(2):
                n = int(m.group(2))
                k = m.start()
                while k > a and text[k - 1].isspace():
                    k -= 1
                # A wrapped line can begin with a number and a stop; a list begins with 1 or goes on counting.
                if k > a and not (n == (last or 0) + 1 and (last or text[k - 1] in ":.!?;" or text[k - 1] in HARD)):
                    continue
                last = n
            cuts.append((at, m.end()))
        if not cuts:
            found.append((a, a, b, True, blank))
            continue
        if text[a : cuts[0][0]].strip(WHITE_SPACE):
            found.append((a, a, cuts[0][0], True, False))
        for k, (s, e) in enumerate(cuts):
            last_one = k + 1 == len(cuts)
            found.append((s, e, b if last_one else cuts[k + 1][0], False, blank and last_one))
    return found


class _Open:
    """Open quotations and brackets, innermost last, by the character that closes them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.count: Counter = Counter()

    def push(self, closer: str, i: int) -> None:
        self.stack.append((closer, i))
        self.count[closer] += 1

    def close(self, ch: str, i: int, out: dict[int, int]) -> None:
        """Close the innermost that waits for ``ch``; what stands open inside it has no partner."""
        while self.count[ch]:
            closer, at = self.stack.pop()
            self.count[closer] -= 1
            if closer == ch:
                out[i] = at
                return


def _pairs(text: str, a: int, b: int) -> dict[int, int]:
    """Closing position -> opening position of the quotations and brackets of a unit; what has no partner is left out."""
    out: dict[int, int] = {}
    opened = _Open()
    for m in _PAIRED.finditer(text, a, b):
        i, ch = m.start(), m.group()
        if ch in PAIRS:
            opened.push(PAIRS[ch], i)
        elif ch == "„":
            opened.push("“", i)
        elif ch == "“":
            if opened.count["“"]:
                opened.close("“", i, out)
            else:
                opened.push("”", i)
        elif ch == '"':
            before, after = text[i - 1 : i] if i > a else " ", text[i + 1 : i + 2] if i + 1 < b else " "
            begins = (before.isspace() or before in "([—–（") and not after.isspace()
            if opened.count['"'] and not (begins and opened.stack[-1][0] != '"'):
                opened.close('"', i, out)
            elif not after.isspace():
                opened.push('"', i)
        else:
            opened.close(ch, i, out)
    return out


# ---------------------------------------------------------------- the scan of a text

# What is known of an open place, in bits. What the word before it shows (the lowest two) ...
AT_END, SMALL, NUMBER = 1, 2, 3
# ... the rule that closes it (the next two; 0 if it is only evidence) ...
STOP, CALL, JOINED = 4, 8, 12
# ... and flags: a blank line follows; the next word has a small letter; the word before is a capital, a letter, a short word; the next
# character is a capital; a number or one with letters comes next; the word before has a capital inside a sentence.
BLANK, LOW, CAPITAL, LETTER, SHORT, NEXT_CAPITAL, NUMBERED, TITLE = (1 << k for k in range(4, 12))


class Scan:
    """What a text shows, by place.

    ``first``: where the first sentence begins, -1 if there is none. ``ends``, ``nexts``: where a sentence ends or can end, and where the next
    one begins then. ``places``: for each stop, and each other mark that is open, its number in ``ends`` (-1 if it is evidence only);
    ``keys``: the word before it, a letter or a short number with the word before that, or nothing; ``words``: the next word; ``bits``.
    ``starts``: words that begin a paragraph. ``bare``: keys of short numbers without a stop. ``has_end``: a paragraph or the text ends with a stop.
    """

    __slots__ = ("first", "ends", "nexts", "places", "keys", "words", "bits", "starts", "bare", "has_end")

    def __init__(self, text: str):
        self.first, self.ends, self.nexts = -1, [], []
        self.places, self.keys, self.words, self.bits, self.starts = [], [], [], [], []
        found = units(text)
        self.bare = [k for m in _BARE.finditer(text) if (k := _key_of_number(text, m.start()))]
        self.has_end = text.rstrip(WHITE_SPACE + CLOSERS).endswith(".") or any(u[4] for u in found)
        thai = not text.isascii() and _THAI.search(text) is not None
        paired = _PAIRED.search(text) is not None
        for a, body, b, begins, blank in found:
            begin, end = _skip(text, a, b), b
            while end > begin and text[end - 1].isspace():
                end -= 1
            if begin >= end:
                continue
            if self.nexts:
                self.nexts[-1] = begin
            else:
                self.first = begin
            if begins and (m := _WORD.search(text, body, min(b, body + 40))) and not text[body : m.start()].strip(WHITE_SPACE + OPENERS + "—–"):
                self.starts.append(m.group())
            at = len(self.ends)
            self._marks(text, body, b, blank, _pairs(text, body, b) if paired else {})
            if thai:
                self._thai(text, body, b, at)
            self.ends.append(end)
            self.nexts.append(end)

    def _thai(self, text: str, a: int, b: int, at: int) -> None:
        """Add the spaces of a Thai unit to its ends, which begin with number ``at``."""
        more = [(m.start(), m.end()) for m in _THAI.finditer(text, a, b) if m.start() not in self.ends[at:]]
        if not more:
            return
        old = [*zip(self.ends[at:], self.nexts[at:], range(at, len(self.ends)))]
        both = sorted([*old, *((e, n, -1) for e, n in more)])
        self.ends[at:], self.nexts[at:] = [x[0] for x in both], [x[1] for x in both]
        moved = {x[2]: at + k for k, x in enumerate(both) if x[2] >= 0}
        self.places = [moved.get(p, p) for p in self.places]

    def _marks(self, text: str, a: int, b: int, blank: bool, pairs: dict[int, int]) -> None:
        opens = sorted(pairs.values())
        if opens:
            closing = {o: c for c, o in pairs.items()}
            reach = [*accumulate((closing[o] for o in opens), max)]  # how far what opened so far extends
        apart = any(text[c] in "»›" for c in pairs)  # a quotation may be closed after a space
        done = a  # what is before belongs to an earlier mark
        seen, start = a, a  # the chunk of the last mark looked at begins at `start`
        for m in _MARKS.finditer(text, a, b):
            i, j = m.span()
            if i < done:
                continue
            run = text[i:j]
            stop = run == "."
            if stop and j < b and text[j] in _PLAIN:
                continue
            opened = None
            if j < b and (apart or text[j] != " "):
                j, opened = _belongs(text, i, j, b, pairs)
            done = k = j
            while k < b and text[k].isspace():
                k += 1
            gap, last = k > j, k >= b
            inside = False
            if opens:
                n = bisect_left(opens, i)
                inside = n > 0 and reach[n - 1] >= j
            if inside or last and not stop:
                continue
            then, lead = k, k
            while k < b and (text[k] in _LEADS or text[k].isspace()):
                k += 1
            skipped, ch = text[lead:k], text[k] if k < b else ""
            s = text.rfind(" ", seen, i) + 1 or seen
            piece = text[s:i]
            if len(piece.split()) != 1 or piece[0].isspace() or piece[-1].isspace():  # other white space
                s = i
                while s > seen and not text[s - 1].isspace():
                    s -= 1
            if s > seen or s == a or text[s - 1].isspace():
                start = s
            seen = i
            chunk = text[max(start, i - LONGEST) : i].lstrip(_CHUNK_EDGE)
            m = _WORD.match(text, k)
            word = m.group() if m else ""
            low = word.islower() and word[0].islower()  # no capital inside either, as names like mRNA have
            key, bits = "", 0
            if stop and chunk:
                key, bits = _key(text, a, start, chunk)
            if last:
                if key:
                    self._open(-1, key, "", bits | (AT_END if blank or b == len(text) else 0) | (BLANK if blank else 0))
                continue
            verdict = self._ends(text, i, j, run, opened, gap, skipped, ch, low, chunk, key, a)
            place = -1
            if verdict:
                place = len(self.ends)
                self.ends.append(j)
                self.nexts.append(then)
            rule = verdict if verdict in (STOP, CALL, JOINED) else 0
            if stop and chunk and gap:
                bits |= (SMALL | LOW if low else NUMBER if ch.isdigit() else 0) | (NEXT_CAPITAL if ch.isupper() else 0)
                bits |= NUMBERED if ch.isdigit() or ch.isupper() and any(c.isdigit() for c in word) else 0
                self._open(place if rule else -1, key, word, bits | rule)
            elif rule:
                self._open(place, "", word, rule)
            elif stop and chunk and j == i + 1 and text[j] in ",;:":
                self._open(-1, key, "", bits | SMALL)

    def _open(self, place: int, key: str, word: str, bits: int) -> None:
        self.places.append(place)
        self.keys.append(key)
        self.words.append(word)
        self.bits.append(bits)

    @staticmethod
    def _ends(text: str, i: int, j: int, run: str, opened: int | None, gap: bool, skipped: str, ch: str, low: bool, chunk: str, key: str, a: int) -> int:
        """1 if a sentence ends here, 0 if none does, or the rule that decides by evidence."""
        after = text[j]
        if after in ",，、;；:：":
            return 0
        if opened is not None and text[opened] in QUOTES:
            if any(_is_caseless(c) for c in text[opened + 1 : i]):
                # No capitals to go by: what was announced by a colon or comma is complete, else the speaker follows.
                k = opened
                while k > a and text[k - 1].isspace():
                    k -= 1
                return int(k > a and text[k - 1] in INTRODUCES)
            return _call(skipped, ch, low) if gap else int(ch.isupper() or bool(skipped))
        if run != ".":
            if any(c in HARD for c in run):
                return int(not (run == "．" and i and text[i - 1].isdigit() and after.isdigit()))
            if "!" in run or "?" in run:
                return _call(skipped, ch, low) if gap else int(ch.isupper() or _is_caseless(ch) or bool(skipped))
            # an ellipsis
            return int(gap and (ch.isupper() or ch.isdigit()) and skipped[:1] not in ("—", "–", "-"))
        if not chunk:
            return int(gap and not low)
        before = text[i - 1]
        is_thai = "\u0e00" <= before <= "\u0e7f"
        if not gap:
            # No space: an end only between whole words, never within numbers, files and names.
            if not skipped and _is_caseless(ch) and _is_caseless(before) and not is_thai:
                return 1
            if not ch.isupper() or "/" in chunk or "@" in chunk:
                return 0
            if skipped or j > i + 1:  # a quotation or bracket opens, or one is closed
                return int(not skipped or chunk.isalnum())
            return JOINED
        if is_thai:
            return 0
        if not chunk.isascii() and _DEVANAGARI.search(chunk):
            return int(sum(c.isalpha() for c in chunk) > 3)
        if low:
            return 0 if skipped.strip(_FREE) else STOP
        return STOP if key else 1


def _call(skipped: str, ch: str, low: bool) -> int:
    """After a question or call with a space: an end, unless a small letter or a dash and a small letter go on."""
    if ch.islower() and skipped.strip()[:1] in ("—", "–", "-"):
        return 0
    return CALL if low else 1


def _skip(text: str, a: int, b: int) -> int:
    while a < b and text[a].isspace():
        a += 1
    return a


def _belongs(text: str, i: int, j: int, b: int, pairs: dict[int, int]) -> tuple[int, int | None]:
    """The end of a run of marks with all that belongs to it, and where the outermost quotation or bracket begins that is closed there."""
    opened = None
    while j < b:
        ch = text[j]
        if ch in SOFT or ch in HARD:
            j += 1
        elif (ch in CLOSERS or ch == "“") and pairs.get(j, i) < i:
            opened = pairs[j] if opened is None else min(opened, pairs[j])
            j += 1
        elif ch in "'’" and j + 1 < b and not text[j + 1].isalpha():
            j += 1
        elif ch in "[［" and (m := _NOTE.match(text, j, b)):
            j = m.end()
        elif ch.isspace():
            k = j
            while k < b and text[k] in NARROW:
                k += 1
            if k < b and text[k] in "»›" and pairs.get(k, i) < i:
                opened = pairs[k] if opened is None else min(opened, pairs[k])
                j = k + 1
            else:
                break
        else:
            break
    return j, opened


def _key_of_number(text: str, at: int) -> str:
    """The key of a number that follows the space at ``at``."""
    s = at
    while s and text[s - 1].isalpha() and at - s < LONGEST:
        s -= 1
    return f"{text[s:at].casefold()} #" if s < at else ""


def _key(text: str, a: int, start: int, chunk: str) -> tuple[str, int]:
    """The key of the word before a stop, and its flags; nothing for numbers, file names and the like."""
    letter, number = len(chunk) == 1 and chunk.isalpha(), len(chunk) <= 2 and chunk.isdigit()
    if not letter and not number:
        if _LETTERS.match(chunk) and len(chunk) < LONGEST:
            title = chunk[0].isupper() and start - 2 >= a and text[start - 2].islower() and text[start] == chunk[0]
            return chunk.casefold(), (SHORT if len(chunk) <= SHORT_WORD else 0) | (TITLE if title else 0)
        return "", 0
    e = start
    while e > a and text[e - 1].isspace():
        e -= 1
    s, low = e, max(a, e - LONGEST)
    while s > low and not text[s - 1].isspace():
        s -= 1
    before = text[s:e].strip(_CHUNK_EDGE).casefold()
    if before.replace(".", "").replace(",", "").isdigit():
        before = "#"
    return f"{before} {chunk if letter else '#'}", (LETTER | (CAPITAL if chunk.isupper() else 0)) if letter else 0


# ---------------------------------------------------------------- closing what is open

NEVER, ENDS, START = "never", "ends", "start"
WORD, FIRST = "word", "first"


class Knowledge:
    """What the corpus says: ``never`` or ``ends`` by key, and the words that begin sentences."""

    __slots__ = ("verdict", "starts")

    def __init__(self, rows: list[tuple[str, str, str]] = ()):  # type: ignore[assignment]
        self.verdict = {k: v for kind, k, v in rows if kind == WORD}
        self.starts = {k for kind, k, _ in rows if kind == FIRST}


class _Document:
    """A document's own evidence, with the corpus' behind it."""

    def __init__(self, starts: list[str], keys: list[str], words: list[str], bits: list[int], know: Knowledge):
        self.starts, self.know = starts, know
        self.ending = {k for k, x in zip(keys, bits) if x & BLANK}
        # A name with a small first letter that begins sentences shows nothing of the word before it.
        self.continued = {k for k, w, x in zip(keys, words, bits) if x & 3 == SMALL and w not in know.starts}

    def begins(self, word: str) -> bool:
        return word in self.starts or word in self.know.starts

    def never_ends(self, key: str, following: str, bits: int) -> bool:
        """Before the word ``following``, that before the stop doesn't end a sentence: as the document shows, then the corpus, then the lists."""
        if key in self.ending:
            return False
        known = self.know.verdict.get(key)
        if known:
            return known == NEVER
        before, _, word = key.rpartition(" ")
        if bits & LETTER:
            return before not in LETTER_NOUNS and (bool(bits & CAPITAL) or word not in MAY_END or before.endswith("."))
        if word == "#":
            return before in GERMAN_BEFORE_ORDINAL and following[:1].isalpha() or following.casefold() in MONTHS
        if word in MAY_END:
            return False
        return bool(bits & SHORT) and key in self.continued or word in BEFORE_NAMES or word in BEFORE_NUMBERS

    def is_end(self, key: str, word: str, bits: int) -> bool:
        rule = bits & JOINED
        if rule != STOP:  # a call before a small letter, or a stop joined to the next word
            return self.begins(word)
        if bits & LOW:
            return self.begins(word) and not (key and self.never_ends(key, word, bits))
        if not self.never_ends(key, word, bits):
            return True
        if bits & CAPITAL:  # an initial, or the last word of a sentence
            return bool(bits & NEXT_CAPITAL) and word in self.starts and word in self.know.starts
        return key in BEFORE_NUMBERS and key not in self.know.verdict and not bits & NUMBERED


def closed(starts: list[str], places: list[int], keys: list[str], words: list[str], bits: list[int], know: Knowledge) -> list[int]:
    """The numbers of the open places of a text where no sentence ends."""
    own = None
    out = []
    for p, k, w, x in zip(places, keys, words, bits):
        if p >= 0:
            own = own or _Document(starts, keys, words, bits, know)
            if not own.is_end(k, w, x):
                out.append(p)
    return out


class Splitter:
    """Splits single texts, with the knowledge of a corpus."""

    def __init__(self, knowledge: Knowledge):
        self.know = knowledge

    def __call__(self, text: str) -> list[tuple[int, int]]:
        """Start and end of every sentence, by code points, end exclusive, without outer white space."""
        x = Scan(text)
        no = {*closed(x.starts, x.places, x.keys, x.words, x.bits, self.know)}
        out, begin = [], x.first
        for k, (end, after) in enumerate(zip(x.ends, x.nexts)):
            if k not in no:
                if begin < end:
                    out.append((begin, end))
                begin = after
        return out


# ---------------------------------------------------------------- evidence of the corpus

ODDS = 1_000
RARELY = 20  # an abbreviation before names ends paragraphs that much more rarely than other words
EVIDENCE = ("n", "n_end", "n_small", "n_number", "n_title", "n_open")


def corpus_evidence(scanned: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of all scans: counts per word before a stop and next word, per word that begins a paragraph, and per number without a stop."""
    m = scanned.select("__has_end", F.explode(F.arrays_zip("__keys", "__words", "__bits")).alias("m")).select("__has_end", F.col("m.__keys").alias("key"), F.col("m.__words").alias("next"), F.col("m.__bits").alias("bits"))
    what, rule = F.col("bits").bitwiseAND(3), F.col("bits").bitwiseAND(JOINED)
    count = lambda c: F.sum(c.cast("int")).alias
    stops = m.filter((rule == 0) | (rule == STOP))
    pairs = stops.groupBy("key", "next").agg(F.count(F.lit(1)).alias("n"), count(what == AT_END)("n_end"), count(what == SMALL)("n_small"), count(what == NUMBER)("n_number"), count(F.col("bits").bitwiseAND(TITLE) > 0)("n_title"), count(F.col("__has_end"))("n_open"))
    starts, bare = (scanned.select(F.explode(c).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")) for c in ("__starts", "__bare"))
    return pairs, starts, bare


def decisive(pairs: DataFrame, starts: DataFrame, bare: DataFrame) -> DataFrame:
    """``kind, key, verdict, n`` of the keys whose corpus evidence decides something.

    ``ends``: a letter, or a word that is short or an abbreviation, whose stops end a paragraph or text in at least 1 of 100 cases. ``never``: an
    abbreviation that doesn't. A word is one if at least 3 in 10 of its stops stand before a small letter or a number; a short word also if at
    least 3 in 10 of its stops stand in the middle of a sentence after its capital (a title), at least half of them before words that begin no
    sentences, and it is ``ODDS`` times likelier that it ends paragraphs ``RARELY`` times more rarely than other words than that it is one of
    these. Counted for that are texts that have any such end. A short number with the word before it is judged like a title if it (almost)
    always has its stop (an ordinal). ``start``: a word that begins paragraphs at least once for 50 times that it follows a stop.
    """
    after = pairs.filter("next <> ''").groupBy("next").agg(F.sum("n").alias("m"))
    first = starts.join(after, starts["key"] == after["next"], "left").filter(F.col("m").isNull() | (F.col("n") * 50 >= F.col("m")))
    first = materialize(first.select(F.lit(FIRST).alias("kind"), "key", F.lit(START).alias("verdict"), (F.col("n") + F.coalesce("m", F.lit(0))).alias("n")), "first-words")

    words = first.select(F.col("key").alias("next"))
    small = words.filter(F.col("next").rlike(r"^\p{Ll}"))  # names with a small first letter that begin sentences: a stop before one shows nothing
    no_sign = pairs.filter("n_small > 0").join(small, "next", "left_semi").groupBy("key").agg(F.sum("n_small").alias("n_begun"))
    sums = pairs.filter("key <> ''").groupBy("key").agg(*[F.sum(c).alias(c) for c in EVIDENCE]).join(no_sign, "key", "left")
    keys = materialize(sums.withColumn("n_small", F.col("n_small") - F.coalesce("n_begun", F.lit(0))).drop("n_begun"), "stops")
    n, end = F.col("n"), F.col("n_end")
    is_word, is_number = F.col("key").rlike(_ABBREVIATION), F.col("key").rlike(r" #$")
    brief = is_number | is_word & (F.length("key") <= SHORT_WORD)
    whole = keys.filter(~F.contains("key", F.lit(" "))).agg(F.sum("n_end"), F.sum("n_open")).first()
    share = min(0.99, max(1e-6, float(whole[0] or 0) / max(whole[1] or 0, 1)))
    odds = F.lit(-math.log(RARELY)) * F.least(end, "n_open") + F.lit(math.log((1 - share / RARELY) / (1 - share))) * (F.col("n_open") - F.least(end, "n_open"))
    maybe = keys.filter(brief & (odds >= math.log(ODDS))).select("key")
    named = pairs.filter("next <> '' AND n_small + n_number < n").join(maybe, "key").join(words, "next", "left_anti").groupBy("key").agg(F.sum("n").alias("n_name"))
    judged = keys.join(named, "key", "left").withColumn("named", F.coalesce(F.col("n_name") * 2 >= n, F.lit(False)))
    judged = judged.join(bare.select("key", F.col("n").alias("n_bare")), "key", "left")
    title = F.when(is_number, F.coalesce("n_bare", F.lit(0)) * 10 <= n).otherwise(F.col("n_title") * 10 >= n * 3)
    short = F.col("named") & title | is_word & ((F.col("n_small") + F.col("n_number")) * 10 >= n * 3)
    can_end = end * 100 >= n
    is_letter = F.contains("key", F.lit(" ")) & ~is_number
    verdict = F.when(can_end & (brief | is_letter | short), ENDS).when(short & ~can_end, NEVER)
    return judged.select(F.lit(WORD).alias("kind"), "key", verdict.alias("verdict"), "n").filter("verdict IS NOT NULL").unionByName(first)


# ---------------------------------------------------------------- over tables

SCAN_SCHEMA = "__first int, __ends array<int>, __nexts array<int>, __places array<int>, __keys array<string>, __words array<string>, __bits array<int>, __starts array<string>, __bare array<string>, __has_end boolean"
SENTENCE_SCHEMA = "sentence_no int, start_at int, end_at int"
SCAN_ROWS = 1_000


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _lists(values: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array([*chain.from_iterable(values)], kind))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = Scan("")
    for whole in batches:
        for at in range(0, whole.num_rows, SCAN_ROWS):
            b = whole.slice(at, SCAN_ROWS)
            t = b.schema.names.index("__text")
            found = [Scan(x) if x else nothing for x in b.column(t).to_pylist()]
            lists = [_lists([getattr(x, name) for x in found], kind) for name, kind in (("ends", pa.int32()), ("nexts", pa.int32()), ("places", pa.int32()), ("keys", pa.string()), ("words", pa.string()), ("bits", pa.int32()), ("starts", pa.string()), ("bare", pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns) if i != t), pa.array([x.first for x in found], pa.int32()), *lists, pa.array([x.has_end for x in found], pa.bool_())],
                names=[*(n for n in b.schema.names if n != "__text"), *_names(SCAN_SCHEMA)],
            )


def _pieces(column: pa.Array) -> Callable[[int], list]:
    """The list of each row of a list column, as Python values."""
    offsets, values = column.offsets.to_pylist(), column.values.to_pylist()
    return lambda r: values[offsets[r] : offsets[r + 1]]


def _spans(b: pa.RecordBatch, dropped: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, start and end of every sentence of a batch of scans, less the ``dropped`` (row, number in ``__ends``)."""
    ends, nexts = (b.column(b.schema.names.index(n)) for n in ("__ends", "__nexts"))
    counts = np.diff(ends.offsets.to_numpy())
    base = np.concatenate(([0], np.cumsum(counts)))
    at, after = ends.flatten().to_numpy(), nexts.flatten().to_numpy()
    kept = np.ones(len(at), dtype=bool)
    kept[[base[r] + p for r, p in dropped]] = False
    row, at, after = np.repeat(np.arange(b.num_rows), counts)[kept], at[kept], after[kept]
    opens = np.ones(len(row), dtype=bool)
    opens[1:] = row[1:] != row[:-1]
    begin = np.empty_like(at)
    begin[1:] = after[:-1]
    begin[opens] = b.column(b.schema.names.index("__first")).to_numpy()[row[opens]]
    there = begin < at
    row, begin, at = row[there], begin[there], at[there]
    index = np.arange(len(row))
    opens = np.ones(len(row), dtype=bool)
    opens[1:] = row[1:] != row[:-1]
    number = index - np.maximum.accumulate(np.where(opens, index, 0)) + 1 if len(row) else index
    return row, number, begin, at


def sentences(docs: DataFrame, id_cols: list[str], text_col: str, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``id_cols, sentence_no, start_at, end_at``: one row per sentence of every row of ``docs``.

    Places count code points from 0, end exclusive, without outer white space; ``sentence_no`` counts from 1.
    Null, empty and blank texts have no sentences. Texts are split whole, whatever their length. Equal
    rows give equal rows. Other columns are ignored. A run of more than ``LONGEST`` characters without a space is no word.

    The verdicts of the ``broadcast_keys`` most frequent keys are broadcast; those of all others come to the
    scans that hold their keys by a join on the key, in which no key has more than ``1 / broadcast_keys`` of the rows.
    """
    spark = docs.sparkSession
    ship(spark)
    ids = [F.col(c).alias(f"__id_{k}") for k, c in enumerate(id_cols)]
    rows = docs.select(*ids, F.monotonically_increasing_id().alias("__row"), F.col(text_col).cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"]
    scanned = materialize(rows.mapInArrow(_scan, ", ".join([*fields, SCAN_SCHEMA])), "scans")
    pairs, starts, bare = corpus_evidence(scanned)
    table = materialize(decisive(materialize(pairs, "pairs"), starts, bare), "verdicts")
    many = table.count() > broadcast_keys
    hot = table.orderBy(F.desc("n"), "kind", "key").limit(broadcast_keys) if many else table
    shared = spark.sparkContext.broadcast([tuple(r) for r in hot.select("kind", "key", "verdict").collect()])
    scanned = _with_rare(scanned, table, broadcast_keys) if many else scanned.withColumn("__known", F.lit(None).cast("array<struct<kind:string,key:string,verdict:string>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = Knowledge(shared.value)
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns))
            known = columns["__known"].to_pylist() if columns["__known"].null_count < b.num_rows else [None] * b.num_rows
            places, keys, words, bits, begins = (_pieces(columns[f"__{n}"]) for n in ("places", "keys", "words", "bits", "starts"))
            dropped = []
            for r, more in enumerate(known):
                at = places(r)
                if at:
                    own = _joined(know, more) if more else know
                    dropped += [(r, p) for p in closed(begins(r), at, keys(r), words(r), bits(r), own)]
            row, number, begin, end = _spans(b, dropped)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([*(columns[f"__id_{k}"].take(take) for k in range(len(id_cols))), pa.array(number, pa.int32()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], names=[*id_cols, *_names(SENTENCE_SCHEMA)])

    out = ", ".join(f"`{c}` {docs.select(c).schema[0].dataType.simpleString()}" for c in id_cols)
    return scanned.drop("__row", "__has_end", "__bare").mapInArrow(run, f"{out}, {SENTENCE_SCHEMA}")


def _joined(know: Knowledge, more: list[dict]) -> Knowledge:
    """The shared knowledge and what one text has beside it."""
    own = Knowledge([(r["kind"], r["key"], r["verdict"]) for r in more])
    own.verdict = _Both(own.verdict, know.verdict)
    own.starts = _Either(own.starts, know.starts)
    return own


class _Both(dict):
    """A text's own few verdicts before the shared ones."""

    def __init__(self, own: dict, shared: dict):
        super().__init__(own)
        self.shared = shared

    def get(self, key: str, default: str | None = None) -> str | None:
        return super().get(key) or self.shared.get(key, default)

    def __contains__(self, key: object) -> bool:
        return super().__contains__(key) or key in self.shared


class _Either(set):
    """A text's own few first words and the shared ones."""

    def __init__(self, own: set, shared: set):
        super().__init__(own)
        self.shared = shared

    def __contains__(self, key: object) -> bool:
        return super().__contains__(key) or key in self.shared


def _with_rare(scanned: DataFrame, table: DataFrame, broadcast_keys: int) -> DataFrame:
    """Add to each scan the verdicts of its keys that aren't among the most frequent; only keys and row numbers are shuffled."""
    last = table.orderBy(F.desc("n"), "kind", "key").limit(broadcast_keys).orderBy("n", F.desc("kind"), F.desc("key")).first() if broadcast_keys else None
    rare = table
    if last is not None:
        n, kind, key = F.lit(last["n"]), F.lit(last["kind"]), F.lit(last["key"])
        rare = table.filter((F.col("n") < n) | (F.col("n") == n) & ((F.col("kind") > kind) | (F.col("kind") == kind) & (F.col("key") > key)))
    tagged = lambda c, kind: F.transform(c, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key")))
    held = scanned.select("__row", F.explode(F.array_distinct(F.concat(tagged("__keys", WORD), tagged("__words", FIRST)))).alias("k")).select("__row", "k.kind", "k.key").filter("key <> ''")
    found = held.join(rare.select("kind", "key", "verdict"), ["kind", "key"]).groupBy("__row").agg(F.collect_list(F.struct("kind", "key", "verdict")).alias("__known"))
    return scanned.join(found, "__row", "left")

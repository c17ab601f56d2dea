"""Sentence units across languages and scripts, disambiguated by the document itself.

Method. A first pass gathers evidence from unambiguous occurrences: a token with a full stop that
goes on in lower case or with a figure is an abbreviation, one that is also written without the
stop is a word; a capitalised word that also occurs in lower case is a common word, one that
occurs capitalised in mid-sentence is a name; a word that follows figures with a stop is a month; a
Thai chunk behind a short opening chunk is a family name. The evidence is summed per document and,
as fallback, over the corpus; what follows from sums is decided on the sums, so the result does not
depend on how rows are spread. No list of abbreviations is built in. Each block then gets just the
evidence for its own ambiguous tokens (equi-joins on document and token, so no document is gathered
in one task) and is cut by rules for its script: full stops in Latin script, the danda, ideographic
stops, and spaces in Thai.

Quotations and brackets are matched first. Nothing is cut inside them; a quotation keeps the clause
that names its speaker; one that stands alone is a unit.

Lengths that are rules of writing, not bounds on data: an abbreviation has at most six letters
between stops, a clause that names a speaker at most 60 characters (24 in Han), a Thai family name is
known by its first five characters, a name before an ellipsis that occurs nowhere else has at most 8.

Defined cases: null and blank texts give no units; the current row of a block counts; null ids are
dropped; marks without a counterpart are plain characters; text without any boundary is one unit.
Whole texts are read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import current_rows, cut

#: Verbs that name a speaker, by script. Fixed values.
SAID_HAN = "说完|说道|问道|喊道|答道|回答|低声说|说|问|喊|叫|道|答|說|問"
SAID_DEVA = "पूछा|कहा|बोला|बोली"
SAID_LATIN = "said|asked|cried|whispered|replied|shouted|answered|announced|sagte|fragte|rief|antwortete|flüsterte"

STOPS = ".!?。！？．｡।॥…؟"
HARD = set("!?。！？．｡।॥؟")
CLOSERS = "\"'”’»」』)）]】》›"
PAIR = {"“": "”", "„": "“", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "【": "】"}
BRACKETS = set("(（[【")
_MARKS = re.compile("[\n\"" + re.escape("".join(PAIR) + "".join(PAIR.values()) + ")）]】”」』»") + "]")
#: Where a cut can be decided: end marks, opening marks and line breaks; in Thai also spaces.
_HOP = re.compile("[\n\"" + re.escape(STOPS + "".join(PAIR)) + "]")
_HOP_THAI = re.compile("[\\s\"" + re.escape(STOPS + "".join(PAIR)) + "]")
_RUN = re.compile(f"[{re.escape(STOPS)}](?:[{re.escape(STOPS)}]|\\s(?=[.]{{2}}))*")
_TOKEN_BEFORE = re.compile(r"[^\s(\[{\"“„«‘'「『（—–，。、：；！？,;:!?]+\Z")
_WORD_AFTER = re.compile(r"[^\W_][\w'’-]*(?:\.[^\W\d_](?=\.))*")
_CAPWORD = re.compile(r"(?<![\w.])([A-ZÀ-ÖØ-Þ][\w'’-]*)")
_LOWWORD = re.compile(r"(?<![\w.])([a-zß-öø-ÿ][\w'’]+)")
_DOTTED = re.compile(r"(?<![0-9A-Za-zÀ-ɏऀ-ॿ.])([A-Za-zÀ-ɏऀ-ॿ]{1,6}(?:\.[A-Za-zÀ-ɏ]{1,3})*)\.(?=(\s*)(\S?)(\S*))")
_PLAIN = re.compile(r"(?<![0-9A-Za-zÀ-ɏऀ-ॿ.])([A-Za-zÀ-ɏऀ-ॿ]{1,6})(?![0-9A-Za-zÀ-ɏऀ-ॿ.])")
_MONTH = re.compile(r"(?<!\d)\d{1,2}\.\s+([A-ZÄÖÜ]\w+)")
_MID = re.compile(r"[a-zß-öø-ÿ,;]\s+([A-ZÀ-ÖØ-Þ][\w'’-]*)")
_THAI = re.compile(r"[\u0e00-\u0e7f]")
_THAI_OPEN = re.compile(r"\A\s*([฀-๿]{2,8}) ([฀-๿]{4,})")
_SAYS_HAN = re.compile(rf"[^，。！？：；…\s「『“”』」]{{1,24}}?(?:{SAID_HAN})(?=[，。！？…．]|\Z)")
_SAYS_DEVA = re.compile(rf"[^।॥?!\",]{{1,60}}(?:{SAID_DEVA})\s*[।॥?!]")
_SAYS_LATIN = re.compile(rf"[^.!?\"“„]{{1,60}}\s(?:{SAID_LATIN})\s*[.!?]")
_THAI_FIRST = re.compile(r"\s*([฀-๿]{5,})")


def script(c: str) -> str:
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o <= 0x1EFF:
        return "latin" if c.isalpha() else "other"
    if 0x900 <= o <= 0x97F:
        return "deva"
    if 0xE00 <= o <= 0xE7F:
        return "thai"
    if 0x3040 <= o <= 0x30FF or 0x3400 <= o <= 0x9FFF or 0xF900 <= o <= 0xFAFF or o >= 0x20000 and o < 0x32000:
        return "han"
    return "other"


def symbol(c: str) -> bool:
    return unicodedata.category(c) in ("So", "Sk", "Cf", "Mn", "Cs") or 0x20000 <= ord(c) < 0x32000


def matches(text: str) -> dict[int, int]:
    """Opening mark -> its closing mark. Marks that do not pair within a paragraph are left out."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    straight = -1
    for m in _MARKS.finditer(text):
        i, c = m.start(), m[0]
        if c == '"':
            if straight >= 0:
                out[straight] = i
                straight = -1
            elif i == 0 or text[i - 1].isspace() or text[i - 1] in "(（[:：,，" or script(text[i - 1]) in ("han", "thai") or text[i - 1] in STOPS + CLOSERS:
                straight = i
        elif stack and c == stack[-1][0]:
            _, at = stack.pop()
            out[at] = i
        elif c in PAIR:
            stack.append((PAIR[c], i))
        elif c in ")）]】”」』»" and any(x[0] == c for x in stack):
            while stack[-1][0] != c:
                stack.pop()
            _, at = stack.pop()
            out[at] = i
        elif c == "\n" and text[i + 1 : i + 2] == "\n":
            stack.clear()
            straight = -1
    return out


def mixed(word: str) -> bool:
    """A name that starts in lower case, like a brand: some later letter is a capital."""
    return word[:1].islower() and any(c.isupper() for c in word[1:])


class Evidence:
    """Counts for the ambiguous tokens of one block: key -> (a, b, c, d), of the document and of the corpus."""

    def __init__(self, doc: dict[str, tuple], corpus: dict[str, tuple], names: set[str]) -> None:
        self.doc, self.corpus, self.names = doc, corpus, names

    def abbreviation(self, w: str) -> bool:
        if len(w) == 1 and w.isalpha() or "." in w and len(w) <= 8:
            return True
        low, cap, plain, _ = self.doc.get("w:" + w, (0, 0, 0, 0))
        if plain == 0 and low > 0:
            return True
        if plain > 0 and low == 0:
            return False
        low, cap, plain, _ = self.corpus.get("w:" + w, (0, 0, 0, 0))
        if len(w) <= 6 and low + cap >= 3 and (low or w[:1].isupper()):
            return plain * 20 <= low + cap
        return False

    def ender(self, w: str) -> bool:
        low, cap, plain, common = self.corpus.get("w:" + w, (0, 0, 0, 0))
        return low + cap >= 5 and common * 5 >= low + cap

    def common(self, x: str) -> bool:
        if len(x) < 2:
            return False
        low, mid, _, _ = self.doc.get("x:" + x, (0, 0, 0, 0))
        if low > mid:
            return True
        if mid > low:
            return False
        low, mid, _, _ = self.corpus.get("x:" + x, (0, 0, 0, 0))
        return low > mid

    def month(self, x: str) -> bool:
        _, _, after, total = self.corpus.get("x:" + x, (0, 0, 0, 0))
        return after * 2 > total > 0

    def family(self, prefix: str) -> bool:
        a, b, _, _ = self.corpus.get("s:" + prefix, (0, 0, 0, 0))
        return a > 0 and a >= b


EMPTY = Evidence({}, {}, set())


def _full_stop(text: str, i: int, k: int, pos: int, ev: Evidence) -> bool:
    """Whether the single full stop at ``i`` ends a sentence; ``k`` is where the next character would start."""
    before = _TOKEN_BEFORE.search(text, pos, i)
    if before and script(before[0][-1]) == "latin" and any(script(c) in ("han", "thai") for c in before[0]):
        before = re.compile(r"[A-Za-zÀ-ɏ.]+\Z").search(text, before.start(), i)
    w = before[0] if before else ""
    gap = k
    while gap < len(text) and text[gap].isspace():
        gap += 1
    if gap >= len(text):
        return True
    nxt = text[gap]
    spaced = gap > k
    prev = text[i - 1 : i]
    if not spaced and k == i + 1:
        if prev.isdigit() and nxt.isdigit() or nxt in ",;:)]":
            return False
        if not (nxt.isupper() and len(w) >= 2 and prev.islower()) and script(nxt) not in ("han",) and nxt not in "“„\"「『(（":
            return False
        if ev.abbreviation(w) or "." in w:
            return False
    if prev and script(prev) in ("deva", "thai"):
        return False
    word = _WORD_AFTER.match(text, gap)
    x = word[0] if word else ""
    if w.isdigit():
        if not text[pos : before.start()].strip():  # numbering opens the unit
            return False
        if nxt.islower() and not mixed(x) or nxt.isdigit():
            return False
        head = text[pos : before.start()].rstrip()
        if x and ev.month(x):
            return False
        if head.endswith("."):
            return True
        if x and ev.common(x):
            return True
        return not re.search(r"(?:\A|\s)(?:[Aa]m|vom|den|dem|zum|bis|ab)\Z", head)
    if w and ev.abbreviation(w):
        if nxt.isdigit() or nxt in ",;:":
            return False
        if nxt.islower():
            return mixed(x) and ev.ender(w)
        if not nxt.isalpha():
            return ev.ender(w)
        if script(nxt) != "latin":
            return ev.ender(w) or script(prev) != "latin"
        return ev.common(x) and not (len(w) == 1 and w.isupper()) or ev.ender(w)
    if nxt.islower() and not mixed(x):
        return False
    return True


def _speaker(text: str, k: int) -> bool:
    """Whether the text from ``k`` on, behind a closed quotation, belongs to it."""
    gap = k
    while gap < len(text) and text[gap].isspace():
        gap += 1
    rest = text[gap : gap + 90]
    if not rest:
        return False
    c = rest[0]
    if c in ",，、;":
        return True
    if rest.startswith(("と", "って", "という")):
        return True
    if c.islower():
        word = _WORD_AFTER.match(rest)
        return not mixed(word[0] if word else c)
    s = script(c)
    if s == "han":
        m = re.match(rf"[^，。！？：；…\s「『“”」』]{{1,24}}?(?:{SAID_HAN})(?=[，。！？…．]|\Z)", rest)
        return bool(m)
    if s == "deva" or re.match(rf"[^।॥?!\",]{{1,60}}(?:{SAID_DEVA})\s*[।॥?!]", rest):
        return bool(re.match(rf"[^।॥?!\",]{{1,60}}(?:{SAID_DEVA})\s*[।॥?!]", rest))
    if s == "latin":
        return bool(re.match(rf"[^.!?\"“„]{{1,60}}\s(?:{SAID_LATIN})\s*[.!?]", rest))
    return False


def _line_breaks(text: str, first: int, cuts: list[int], soft: list[int], ev: Evidence, quote: bool) -> list[int]:
    """Line breaks that part units: all where there is no end mark at all, those inside a run of lines without
    marks that each start like a sentence, and those before a word that plainly starts one."""
    n = len(text)
    breaks = []  # (place, last character before, start of the next line) of the breaks that end marks leave open
    for i in soft:
        j = bisect_left(cuts, i)
        if j and not text[cuts[j - 1] : i].strip():
            continue
        k = i + 1
        while k < n and (text[k].isspace() or quote and text[k] == ">"):
            k += 1
        if k < n:
            breaks.append((i, text[first:i].rstrip(CLOSERS + " ")[-1:], k))
    if not cuts:
        return [i for i, _, _ in breaks]

    def starts(k: int) -> bool:
        return text[k].isupper() or script(text[k]) not in ("latin", "other")

    out = []
    at = 0
    while at < len(breaks):
        # a run: neighbouring open breaks with no cut between them
        end = at
        while end + 1 < len(breaks) and "\n" not in text[breaks[end][2] : breaks[end + 1][0]] and bisect_left(cuts, breaks[end + 1][0]) == bisect_left(cuts, breaks[end][0]):
            end += 1
        run = breaks[at : end + 1]
        listed = len(run) >= 2 and all(starts(k) for _, _, k in run)
        for i, left, k in run:
            if listed or left and script(left) in ("han", "thai") and script(text[k]) in ("han", "thai"):
                out.append(i)
            elif text[k].isupper() and left not in ",;:":
                word = _WORD_AFTER.match(text, k)
                if word and ev.common(word[0]):
                    out.append(i)
        at = end + 1
    return out


def spans(text: str, ev: Evidence = EMPTY, quote: bool = False) -> list[tuple[int, int]]:
    """Sentence units as (start, end), without surrounding white space."""
    n = len(text)
    pair = matches(text)
    thai = len(_THAI.findall(text)) * 3 > len(text)
    cuts: list[int] = []
    pos = 0
    if quote:
        m = re.match(r"\s*>+\s*", text)
        pos = m.end() if m else 0
    first = pos
    i = pos
    soft: list[int] = []  # line breaks, decided once it is known whether there are end marks

    def absorb(k: int) -> int:
        """Closing marks, stops and symbols that belong to the unit before."""
        while k < n and (text[k] in CLOSERS and k not in pair or text[k] in STOPS):
            if text[k] == '"' and k in pair:
                break
            k += 1
        j = k
        while j < n and text[j].isspace() and text[j] != "\n":
            j += 1
        if j < n and symbol(text[j]):
            e = j
            while e < n and symbol(text[e]):
                e += 1
            if e >= n or text[e].isspace():
                return e
        return k

    def close(k: int) -> None:
        nonlocal pos
        cuts.append(k)
        pos = k

    hop = _HOP_THAI if thai else _HOP
    while i < n:
        at = hop.search(text, i)
        if at is None:
            break
        i = at.start()
        c = text[i]
        if i in pair:
            j = pair[i]
            inner = text[i + 1 : j].rstrip()
            opens = not text[pos:i].strip() if not quote else not re.sub(r"[>\s]", "", text[pos:i])
            ended = bool(inner) and inner.rstrip(CLOSERS)[-1:] in set(STOPS)
            k = j + 1
            if c in BRACKETS:
                if opens and ended:
                    k = absorb(k)
                    close(k)
                i = max(k, j + 1)
                continue
            more = k < n and text[k] in STOPS
            if more:
                i = k
                continue
            k2 = absorb(k)
            if opens or ended:
                if not _speaker(text, k2) and (opens or not thai or ended):
                    close(k2)
            i = k2
            continue
        if c in STOPS:
            run = _RUN.match(text, i)
            e = run.end()
            marks = text[i:e].replace(" ", "")
            k = absorb(e)
            nxt_at = k
            while nxt_at < n and text[nxt_at].isspace():
                nxt_at += 1
            nxt = text[nxt_at : nxt_at + 1]
            word = _WORD_AFTER.match(text, nxt_at)
            lower = nxt.islower() and not mixed(word[0] if word else nxt)
            if set(marks) & HARD:
                if marks == "．" and text[i - 1 : i].isdigit() and nxt.isdigit() and nxt_at == k:
                    end = False
                else:
                    end = not (lower and set(marks) <= set("!?"))
            elif len(marks) > 1 or marks == "…":
                head = text[pos:i].strip()
                end = not lower and not (head in ev.names) and nxt not in ",，"
                if marks[0] == "." and e - i > 1 and nxt == "":
                    end = True
            else:
                end = _full_stop(text, i, k, pos, ev)
                if thai and not end and text[k : k + 1].isspace() and not nxt.isdigit():
                    end = True
            if end:
                close(k)
            i = max(k, e) if end else e
            continue
        if c == "\n":
            if text[pos:i].strip():
                soft.append(i)
            i += 1
            continue
        if thai and c.isspace():
            left, right = text[i - 1 : i], text[i + 1 : i + 2]
            if left and right and not right.isspace() and text[pos:i].strip():
                both_latin = script(left) == "latin" and script(right) == "latin"
                figure = right.isdigit() or left.isdigit()
                short = len(text[pos:i].strip()) <= 7 and script(right) == "thai" and not re.search(r"[^฀-๿]", text[pos:i].strip())
                family = script(left) == "thai" and ev.family(text[i + 1 : i + 6])
                comma = left in ",;:"
                if not (both_latin or figure or short or family or comma or right in STOPS or symbol(right) or right in "“\"" and left in ":"):
                    close(i)
            i += 1
            continue
        i += 1
    edges = sorted({first, n, *cuts, *_line_breaks(text, first, cuts, soft, ev, quote)})
    out = []
    for a, b in zip(edges, edges[1:]):
        while a < b and (text[a].isspace() or quote and text[a] == ">"):
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if b > a:
            out.append((a, b))
    return out


# ------------------------------------------------------------------ evidence


#: What is counted, as (kind of token, place among its four counts).
COUNTED = (("w:", 0), ("w:", 1), ("w:", 2), ("x:", 0), ("x:", 1), ("x:", 2), ("x:", 3), ("s:", 0), ("s:", 1))


def count_evidence(text: str, counts: list[Counter], pairs: Counter) -> None:
    """Add the evidence of one text: a Counter per entry of COUNTED, and (token with stop, capitalised word behind it)."""
    low, cap, plain, x_low, x_mid, x_month, x_cap, family, opening = counts
    for m in _DOTTED.finditer(text):
        w, gap, nxt, rest = m[1], m[2], m[3], m[4]
        if not nxt or not gap and nxt not in ",;:":
            continue
        if nxt.islower() and not mixed(nxt + rest) or nxt.isdigit() or nxt in ",;:":
            low[w] += 1
        else:
            cap[w] += 1
            if nxt.isupper():
                x = _WORD_AFTER.match(nxt + rest)
                pairs[w, x[0] if x else nxt] += 1
    plain.update(_PLAIN.findall(text))
    x_low.update(_LOWWORD.findall(text))
    x_mid.update(_MID.findall(text))
    x_month.update(_MONTH.findall(text))
    x_cap.update(_CAPWORD.findall(text))
    m = _THAI_OPEN.match(text)
    if m:
        family[m[2][:5]] += 1
    m = _THAI_FIRST.match(text)
    if m:
        opening[m[1][:5]] += 1


def needs(text: str) -> list[str]:
    """Keys of the tokens on which a cut of ``text`` may depend."""
    out = set()
    for m in _DOTTED.finditer(text):
        out.add("w:" + m[1])
    for m in re.finditer(r"[.\n]\s*([A-ZÀ-ÖØ-Þ][\w'’-]*)", text):
        out.add("x:" + m[1])
    for m in re.finditer(r"[฀-๿] ([฀-๿]{4,})", text):
        out.add("s:" + m[1][:5])
    return sorted(out)


_HESITANT = re.compile(r"(?:\A|(?<=[。！？．」』”…\s]))([㐀-鿿]{2,14})(?:…+|\.{3,})(?=[^\s…。])")


def hesitant(text: str) -> list[str]:
    """Chunks that stand before an ellipsis where a sentence starts: a name, or a whole sentence?"""
    return sorted({m[1] for m in _HESITANT.finditer(text)})


FACTS = "kind string, id string, doc string, token string, other string, place int, n bigint"


def facts(blocks: DataFrame) -> DataFrame:
    """What one pass over the texts yields, as rows of kind

    count: how often a token of a document was seen in one of the four ways its kind is counted (place), summed per batch;
    pair: token with a stop and the capitalised word behind it (other), with their number; need: a token of a block on
    which a cut depends; chunk: one before an ellipsis. ``blocks``: id, doc_id, text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str | None, list[Counter]] = defaultdict(lambda: [Counter() for _ in COUNTED])
            pairs: Counter = Counter()
            kind, ids, docs, tokens, other, place, n = [], [], [], [], [], [], []
            for ident, doc, text in zip(batch.column("id").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                count_evidence(text, counts[doc], pairs)
                for k, found in (("need", needs(text)), ("chunk", hesitant(text) if "…" in text or "..." in text else ())):
                    kind += [k] * len(found)
                    ids += [ident] * len(found)
                    docs += [doc] * len(found)
                    tokens += found
            other += [None] * len(kind)
            place += [None] * len(kind)
            n += [None] * len(kind)
            for doc, own in counts.items():
                for k, ((prefix, where), c) in enumerate(zip(COUNTED, own)):
                    if not c:
                        continue
                    tokens += [prefix + t[:1].upper() + t[1:] for t in c] if k == 3 else [prefix + t for t in c]
                    n += c.values()
                    place += [where] * len(c)
                    docs += [doc] * len(c)
            rows = len(tokens) - len(kind)
            kind += ["count"] * rows
            ids += [None] * rows
            other += [None] * rows
            for (w, x), m in pairs.items():
                kind.append("pair")
                ids.append(None)
                docs.append(None)
                tokens.append(w)
                other.append(x)
                place.append(None)
                n.append(m)
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.string()) for x in (kind, ids, docs, tokens, other)], pa.array(place, pa.int32()), pa.array(n, pa.int64())], names=["kind", "id", "doc", "token", "other", "place", "n"])

    return blocks.where(F.col("text").isNotNull()).select(F.col("id").cast("string").alias("id"), "doc_id", "text").mapInArrow(run, FACTS)


def _sums(found: DataFrame, *keys: str) -> DataFrame:
    """The four counts per key."""
    at = lambda k: F.coalesce(F.sum(F.when(F.col("place") == k, F.col("n"))), F.lit(0)).alias("abcd"[k])
    return found.where("kind = 'count'").groupBy(*keys).agg(*[at(k) for k in range(4)])


def document_evidence(found: DataFrame, need: DataFrame) -> DataFrame:
    """doc, token and four counts over all blocks of the document, for the documents and tokens in ``need`` (doc, token). ``found``: from :func:`facts`."""
    return _sums(found.where("doc is not null and token not like 's:%'"), "doc", "token").join(need.where("doc is not null").select("doc", "token").distinct(), ["doc", "token"], "left_semi")


def corpus_evidence(found: DataFrame, need: DataFrame) -> DataFrame:
    """token and four counts over the corpus, for the tokens in ``need``; the fourth of a word with a stop says how often a common word follows.

    What is common is decided on the summed counts, so the result does not depend on how the blocks are spread. Writes the sums.
    """
    total = cut(_sums(found, "token"), "tokens")
    common = total.where("token like 'x:%' and a > b").select(F.substr("token", F.lit(3)).alias("other"))
    follows = found.where("kind = 'pair'").groupBy("token", "other").agg(F.sum("n").alias("n")).join(common, "other", "left_semi").groupBy(F.concat(F.lit("w:"), "token").alias("token")).agg(F.sum("n").alias("n"))
    used = total.join(need.select("token").distinct(), "token", "left_semi")
    return used.join(follows, "token", "left").select("token", "a", "b", "c", F.when(F.col("token").startswith("w:"), F.coalesce("n", F.lit(0))).otherwise(F.col("d")).alias("d"))


def names_before_ellipsis(blocks: DataFrame, chunks: DataFrame, buckets: int = 32) -> DataFrame:
    """doc, token: chunks before an ellipsis that the same document mostly uses inside longer clauses. ``chunks``: doc, token.

    The chunks of a document meet its blocks in up to ``buckets`` portions, so no row carries all of a long document.
    """

    @F.pandas_udf("array<struct<chunk:string,inside:int,whole:int>>")
    def count(texts: pd.Series, chunks: pd.Series) -> pd.Series:
        def one(t: str, cs: object) -> list[dict]:
            out = []
            for c in cs:
                inside = whole = 0
                at = t.find(c)
                while at >= 0:
                    nxt = t[at + len(c) : at + len(c) + 1]
                    if nxt and script(nxt) == "han":
                        inside += 1
                    elif nxt and nxt not in "….":
                        whole += 1
                    at = t.find(c, at + 1)
                out.append({"chunk": c, "inside": inside, "whole": whole})
            return out

        return pd.Series([one(t, c) for t, c in zip(texts, chunks)])

    per_doc = chunks.where("doc is not null").distinct().groupBy(F.col("doc").alias("doc_id"), F.pmod(F.xxhash64("token"), F.lit(buckets)).alias("k")).agg(F.sort_array(F.collect_list("token")).alias("chunks"))
    counted = blocks.select("doc_id", "text").join(per_doc, "doc_id").select("doc_id", F.explode(count("text", "chunks")).alias("h")).groupBy("doc_id", "h.chunk").agg(F.sum("h.inside").alias("inside"), F.sum("h.whole").alias("whole"))
    aspect = F.col("chunk").rlike("[了着过是]")
    name = (F.col("inside") > F.col("whole")) | ((F.col("inside") == 0) & (F.col("whole") == 0) & ~aspect & (F.length("chunk") <= 8))
    return counted.where(name).select(F.col("doc_id").alias("doc"), F.col("chunk").alias("token"))


def running_text(blocks: DataFrame) -> DataFrame:
    """Current paragraph and quote blocks: id, doc_id, kind, text."""
    rows = current_rows(blocks, ["id"], {"doc_id": "doc_id", "kind": "block_type", "text": "text_slice"})
    return rows.where(F.col("kind").isin("paragraph", "quote") & F.col("text").isNotNull()).select("id", "doc_id", "kind", "text")


def units(blocks: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """block_id, unit_index, unit_start, unit_end, text of every sentence unit.

    ``blocks``: id, doc_id, kind, text. The texts are read twice in Python: for the facts and for the cuts (a third time
    in documents with words before an ellipsis). Writes blocks, facts and evidence. Corpus evidence is broadcast only
    while it has at most ``broadcast_rows`` rows; beyond that it is joined like any table.
    """
    blocks = cut(blocks, "blocks")
    found = cut(facts(blocks), "facts")
    need = found.where("kind = 'need'").select("id", "doc", "token")
    chunks = found.where("kind = 'chunk'").select("id", "doc", "token")
    corpus = cut(corpus_evidence(found, need), "evidence")
    small = corpus.count() <= broadcast_rows
    corpus = corpus.select("token", F.struct(*"abcd").alias("corpus"))
    doc = document_evidence(found, need).select("doc", "token", F.struct(*"abcd").alias("own"))
    known = need.join(doc, ["doc", "token"], "left").join(F.broadcast(corpus) if small else corpus, "token", "left").select("id", "token", "own", "corpus")
    names = chunks.join(names_before_ellipsis(blocks, chunks), ["doc", "token"], "left_semi").select("id", F.concat(F.lit("n:"), "token").alias("token"))
    known = known.unionByName(names, allowMissingColumns=True).groupBy("id").agg(F.collect_list(F.struct("token", "own", "corpus")).alias("known"))
    rows = blocks.withColumn("_id", F.col("id").cast("string")).join(known.withColumnRenamed("id", "_id"), "_id", "left")

    @F.pandas_udf("array<struct<s:int,e:int>>")
    def split(text: pd.Series, kind: pd.Series, known: pd.Series) -> pd.Series:
        def stat(x: dict) -> tuple:
            return (x["a"] or 0, x["b"] or 0, x["c"] or 0, x["d"] or 0)

        out = []
        for t, k, kn in zip(text, kind, known):
            own, corp, names = {}, {}, set()
            for x in kn if kn is not None else ():
                if x["token"].startswith("n:"):
                    names.add(x["token"][2:])
                if x["own"] is not None:
                    own[x["token"]] = stat(x["own"])
                if x["corpus"] is not None:
                    corp[x["token"]] = stat(x["corpus"])
            out.append([{"s": a, "e": b} for a, b in spans(t, Evidence(own, corp, names), k == "quote")])
        return pd.Series(out)

    cutted = rows.select(F.col("id").alias("block_id"), "text", F.posexplode(split("text", "kind", "known")).alias("unit_index", "u"))
    return cutted.select("block_id", "unit_index", F.col("u.s").alias("unit_start"), F.col("u.e").alias("unit_end"), F.substring("text", F.col("u.s") + 1, F.col("u.e") - F.col("u.s")).alias("text"))

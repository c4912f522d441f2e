"""Noise of scanned pages: found, and repaired into continuous paragraphs.

Lines are read in three steps. Page edges come first: page numbers by their
form and place, headings by fuzzy repetition of lines at page edges (within the
text, and of the rest over the corpus). Then words broken at line ends are
joined, also over a page edge; the corpus vocabulary decides where the hyphen
belongs to the word. Misread characters are found in what is left: a word that
is rare beside a vocabulary word from which it differs by what scanners
exchange.

The vocabulary is counted over all texts. The dictionary of misread words is
sent to the workers in blocks of bounded size, one pass over the texts a block;
all other questions to the corpus are joins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.session import cut_lineage

# Fixed values: (as misread, as printed); what scanners exchange.
MISREAD = (
    ("c", "e"), ("0", "o"), ("|", "i"), ("|", "l"), ("5", "s"), ("1", "l"), ("1", "i"), ("ii", "u"), ("li", "h"), ("rn", "m"), ("m", "rn"),
    ("vv", "w"), ("cl", "d"), ("8", "b"), ("6", "b"), ("9", "g"), ("2", "z"), ("f", "t"), ("н", "и"), ("0", "о"), ("ьi", "ы"), ("ьі", "ы"), ("п", "л"), ("н", "п"),
    ("6", "б"), ("3", "з"), ("4", "ч"), ("и", "н"), ("л", "п"), ("п", "н"), ("ш", "щ"), ("е", "с"), ("с", "е"), ("8", "в"),
)
#: A word of letters alone counts as misread beside a word at least so many times as frequent.
RARE_BESIDE = 10
#: Misread words of one block, the bound of what is sent to the workers at once.
BLOCK = 500_000
#: Texts in which a line must stand at page edges to count as a heading of the corpus.
HEADING_TEXTS = 3
#: Words counted by a worker before they are passed on.
COUNTED = 300_000

TOKEN = re.compile(r"[\w|]+")
DIGITS = "[0-9OolI|]{0,3}[0-9][0-9OolI|]{0,3}"
PAGE = re.compile(rf"(?:[-–—]\s*{DIGITS}\s*[-–—]|\[\s*{DIGITS}\s*\]|(?:[СсPp]|[Сс]тр|pp|[Pp]age)\.?\s*{DIGITS}|[.·•|]?\s*[0-9]{{1,4}})")
PAGE_LINE = re.compile(rf"^[ \t]*{PAGE.pattern}[ \t]*$", re.M)
BESIDE = re.compile(r"^([0-9]{1,4})\s{2,}(\S.*)$|^(.*\S)\s{2,}([0-9]{1,4})$")
BESIDE_LINE = re.compile(r"^[ \t]*[0-9]{1,4}\s{2,}\S|\S\s{2,}[0-9]{1,4}[ \t]*$", re.M)
UPPER_LINE = re.compile(r"^(?=[^\n]*[A-ZА-ЯЁ][^\na-zа-яё]{0,9}[A-ZА-ЯЁ])[^\n]{5,}$", re.M)
BREAK = re.compile("([^\\W\\d_])([-\u2010\u2011\u00ac\u00ad])[ \\t]*$")
JOINED = re.compile("(?<=[^\\W\\d_])[-\u2010\u2011\u00ac\u00ad][ \\t]*\n\\s*(?=[^\\W\\d_])")
HYPHENS = ("-", "\u2010", "\u2011", "\u00ac", "\u00ad")
LETTERS = re.compile(r"[^\W\d_]")
ENDS = (".", "!", "?", "…")


def signature(line: str) -> str:
    """Letters of a line, by which repetitions are found."""
    return "".join(LETTERS.findall(line)).casefold()


def alike(a: str, b: str) -> bool:
    """Signatures that differ by at most one letter in eight."""
    limit = allowed(min(len(a), len(b)))
    if abs(len(a) - len(b)) > limit:
        return False
    if a == b:
        return True
    # only the band about the diagonal can stay within the limit
    row = {j: j for j in range(limit + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - limit), min(len(b), i + limit) + 1):
            best = row.get(j, limit + 1) + 1
            if j:
                best = min(best, new.get(j - 1, limit + 1) + 1, row.get(j - 1, limit + 1) + (x != b[j - 1]))
            new[j] = best
        if min(new.values()) > limit:
            return False
        row = new
    return row.get(len(b), limit + 1) <= limit


def allowed(length: int) -> int:
    return max(1, length // 8)


def pieces(s: str) -> list[str]:
    """A signature in one piece more than alike ones may have edits: one piece at least stands whole in each of them."""
    n = allowed(len(s)) + 1
    edges = [len(s) * k // n for k in range(n + 1)]
    return [s[x:y] for x, y in zip(edges, edges[1:]) if y > x]


def repetitions(signs: dict[int, str]) -> list[list[int]]:
    """Lines of alike signatures together, the most frequent signature leading; whichever share a piece are compared."""
    lines: dict[str, list[int]] = {}
    for i, s in signs.items():
        lines.setdefault(s, []).append(i)
    leading: dict[str, list[str]] = {}
    sizes: set[int] = set()
    groups: dict[str, list[int]] = {}
    for s, own in sorted(lines.items(), key=lambda kv: (-len(kv[1]), kv[0])):
        tried: set[str] = set()
        lead = None
        for key in (s[i : i + n] for n in sizes for i in range(len(s) - n + 1)):
            for t in leading.get(key, ()):
                if t not in tried:
                    tried.add(t)
                    if alike(s, t):
                        lead = t
                        break
            if lead is not None:
                break
        if lead is None:
            groups[s] = list(own)
            for piece in pieces(s):
                leading.setdefault(piece, []).append(s)
                sizes.add(len(piece))
        else:
            groups[lead] += own
    return list(groups.values())


def _classes() -> tuple[list[tuple[str, str]], dict[int, str]]:
    """Pairs of letters to be read as one, and letter -> representative of the letters that scanners exchange for it."""
    lead: dict[str, str] = {}

    def find(ch: str) -> str:
        while lead.setdefault(ch, ch) != ch:
            ch = lead[ch]
        return ch

    for bad, good in MISREAD:
        if len(bad) == len(good) == 1:
            x, y = sorted((find(bad), find(good)))
            lead[y] = x
    wide = [(bad, good) if len(bad) > len(good) else (good, bad) for bad, good in MISREAD if len(bad) != len(good)]
    return sorted(set(wide)), {ord(ch): find(ch) for ch in lead}


WIDE, CLASS = _classes()


def skeleton(sign: str) -> str:
    """Signature without what scanners exchange: equal for a line and its misread copies."""
    for two, one in WIDE:
        sign = sign.replace(two, one)
    return sign.translate(CLASS)


@dataclass
class Page:
    """Lines of a text and what they are."""

    lines: list[str]
    noise: dict[int, set[str]] = field(default_factory=dict)  # line -> kinds of noise
    unsure: dict[int, str] = field(default_factory=dict)  # line -> skeleton of a heading that the corpus must confirm

    def next_text(self, i: int, known: Iterable[str] = ()) -> int | None:
        """Next line of running text, over page edges."""
        for k in range(i + 1, len(self.lines)):
            if self.lines[k].strip() and k not in self.noise and self.unsure.get(k) not in known:
                return k
        return None


def read_page(text: str) -> Page:
    """Find the page edges of a text."""
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    page = Page(lines)
    if len(lines) < 2:
        return page
    edges = PAGE_LINE.search(text) is not None
    if not edges and not UPPER_LINE.search(text) and not BESIDE_LINE.search(text) and len(lines) < 4:
        return page
    bare = [s.strip() for s in lines]
    filled = [i for i, s in enumerate(bare) if s]
    place = {i: k for k, i in enumerate(filled)}
    width = max((len(s) for s in bare), default=0)
    if edges:
        for i in filled:
            s = bare[i]
            if PAGE.fullmatch(s) and 0 < place[i] < len(filled) - 1:
                page.noise[i] = {"page_number"}

    def beside(i: int, step: int) -> str | None:
        k = place[i] + step
        return bare[filled[k]] if 0 <= k < len(filled) else None

    def at_page_number(i: int) -> bool:
        k = place[i]
        return any(0 <= k + d < len(filled) and "page_number" in page.noise.get(filled[k + d], ()) for d in (-1, 1))

    def before(i: int) -> str | None:
        """Running text before the line, over page numbers."""
        for k in range(place[i] - 1, -1, -1):
            if filled[k] not in page.noise:
                return bare[filled[k]]
        return None

    capital: list[tuple[int, str]] = []
    mixed: list[tuple[int, str]] = []
    for i in filled:
        s = bare[i]
        if i in page.noise:
            continue
        m = BESIDE.match(s) if "  " in s or "\t" in s else None
        heading = (m[2] or m[3]) if m else s
        up = sum(map(str.isupper, heading))
        short = len(s) < 0.75 * width and s[-1] not in ENDS and not s[0].islower()
        if up < 4 and not short:
            continue
        n = sum(map(str.isalpha, heading))
        if n < 5:
            continue
        if up >= 0.7 * n:
            capital.append((i, heading))
        elif short:
            # the next word would have fitted: no line of a paragraph ends here
            after = beside(i, 1)
            if after and len(s) + 1 + len(after.split()[0]) <= width and (at_page_number(i) or m or after[0].islower()):
                mixed.append((i, heading))
    signs = {i: signature(h) for i, h in capital + mixed}

    def section(i: int, heading: str) -> bool:
        """A section heading: alone between blank lines and whole sentences, away from page numbers."""
        prev, after = before(i), beside(i, 1)
        alone = (i == 0 or not bare[i - 1]) and (i + 1 == len(bare) or not bare[i + 1])
        within = prev is not None and prev[-1] not in ENDS or after is not None and after[0].islower()
        return alone and not within and not at_page_number(i) and heading == bare[i]

    for group in (capital, mixed):
        sections = {i for i, heading in group if section(i, heading)}
        for same in repetitions({i: signs[i] for i, _ in group}):
            # of a line that stands at one page edge, all fuzzy repetitions are headings
            if len(same) > 1 and not sections.issuperset(same):
                for k in same:
                    page.noise.setdefault(k, set()).add("running_header")
        for i, heading in group:
            if i in page.noise or i in sections:
                continue
            if group is capital and beside(i, 1) is not None and (before(i) is not None or at_page_number(i)):
                page.noise[i] = {"running_header"}
            elif group is mixed and (at_page_number(i) or heading != bare[i]):
                page.unsure[i] = skeleton(signs[i])
    for i, kinds in page.noise.items():
        if "running_header" in kinds and ("  " in bare[i] or "\t" in bare[i]) and BESIDE.match(bare[i]):
            kinds.add("page_number")
    return page


def broken_words(page: Page, known: Iterable[str] = ()) -> dict[int, tuple[int, str]]:
    """Line -> (next line, the word with its hyphen, in small letters) of words broken over two lines."""
    out = {}
    for i, line in enumerate(page.lines):
        bare = line.rstrip(" \t")
        if not bare.endswith(HYPHENS) or i in page.noise or page.unsure.get(i) in known or not (m := BREAK.search(line)):
            continue
        k = page.next_text(i, known)
        if k is None:
            continue
        start = page.lines[k].lstrip()
        if not start[0].isalpha() or not start[0].islower():
            continue
        left = re.search(r"(?:[^\W_]|[|-])+$", line[: m.end(1)])
        right = re.match(r"(?:[^\W_]|\|)+(?:-[^\W_]+)*", start)
        out[i] = (k, f"{left[0]}-{right[0]}".lower())
    return out


def running_text(page: Page, broken: dict[int, tuple[int, str]], keep: Iterable[str] = (), known: Iterable[str] = ()) -> str:
    """Text without page edges, broken words joined but for the compounds in keep; lines stay."""
    out: list[str] = []
    glue = ""
    for i, line in enumerate(page.lines):
        if i in page.noise or page.unsure.get(i) in known:
            continue
        if glue and not line.strip():
            continue
        line = line.lstrip() if glue else line
        glue = ""
        if i in broken:
            line = BREAK.sub(r"\1-" if broken[i][1] in keep else r"\1", line)
            glue = "join"
        out.append(line if glue else line + "\n")
    return "".join(out)


def repair(text: str | None, misread: dict[str, str], keep: Iterable[str] = (), known: Iterable[str] = ()) -> str | None:
    """Continuous paragraphs of a text; null stays null."""
    if text is None:
        return None
    page = read_page(text)
    known, keep = set(known), set(keep)
    broken = broken_words(page, known)
    lines = page.lines
    width = max((len(s.rstrip()) for s in lines), default=0)
    paragraphs: list[str] = []
    now, blank, edge, last_row, glue = "", False, False, False, ""
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            blank = True
            continue
        if i in page.noise or page.unsure.get(i) in known:
            edge = True
            continue
        row = re.fullmatch(r"[\d.,–—+/-]+(?:\s{2,}[\d.,–—+/-]+)+", s) is not None
        # blank lines about a page edge end no paragraph, unless the line before was a last one
        ends = blank and not (edge and (now[-1:] not in ENDS or len(now.rsplit("\n", 1)[-1]) >= 0.8 * width))
        if not now:
            now = s
        elif glue:
            now += s
        elif ends:
            paragraphs.append(now)
            now = s
        elif row or last_row:
            now += "\n" + s
        elif re.search(r"\d[-–]$", now) and s[0].isdigit():
            now += s
        else:
            now += " " + s
        glue = ""
        if i in broken:
            now = BREAK.sub(r"\1-" if broken[i][1] in keep else r"\1", now)
            glue = "join"
        blank, edge, last_row = False, False, row
    if now:
        paragraphs.append(now)
    return TOKEN.sub(lambda m: _mend(m[0], misread), "\n\n".join(paragraphs)) if misread else "\n\n".join(paragraphs)


def _mend(word: str, misread: dict[str, str]) -> str:
    good = misread.get(word.lower())
    if good is None:
        return word
    if word[0].isupper() or not word[0].isalpha() and word[1:2].isupper():
        return good.upper() if word.isupper() and len(word) > 2 else good[0].upper() + good[1:]
    return good


def events(text: str | None, misread: frozenset[str] | dict[str, str], structure: bool = True) -> set[tuple[str, str]]:
    """(noise, question) of a text; a question that is not '' goes to the corpus."""
    if not text:
        return set()
    page = read_page(text)
    broken = broken_words(page)
    out: set[tuple[str, str]] = set()
    if structure:
        for kinds in page.noise.values():
            out.update((k, "") for k in kinds)
        out.update(("running_header", s) for s in page.unsure.values())
        for i, (_, compound) in broken.items():
            soft = not page.lines[i].rstrip().endswith(HYPHENS[:3])
            out.add(("hyphenation", "" if soft else compound))
    if misread:
        body = running_text(page, broken) if page.noise or broken else text
        out.update(("misread", w) for w in misread.keys() & set(TOKEN.findall(body.lower())))
    return out


def _texts(fields: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(field, row_id, text) of several text columns, without texts that say nothing."""
    out = None
    for name, df, id_col, text_col in fields:
        part = df.select(F.lit(name).alias("field"), F.col(id_col).cast("string").alias("row_id"), F.col(text_col).alias("text")).filter("text is not null and trim(text) <> ''")
        out = part if out is None else out.unionByName(part)
    return out


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, in small letters; compounds are counted with their hyphens too."""
    compound = re.compile(r"[^\W_]+(?:-[^\W_]+)+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                body = JOINED.sub("", text.lower())
                seen.update(TOKEN.findall(body))
                if "-" in body:
                    seen.update(compound.findall(body))
            if len(seen) > COUNTED:
                yield out()
        yield out()

    return texts.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _spelled(word: str, undo: bool) -> Iterator[tuple[str, int, int]]:
    """(word with one misreading undone or made, start and end of the place in it)."""
    for bad, good in MISREAD:
        old, new = (bad, good) if undo else (good, bad)
        at = word.find(old)
        while at >= 0:
            yield word[:at] + new + word[at + len(old) :], at, at + len(new)
            at = word.find(old, at + 1)


def _pairs_of_forms(undo: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"], batch["n"]):
                seen = set()
                for form, start, end in _spelled(word, undo):
                    if (form, start, end) not in seen:
                        seen.add((form, start, end))
                        rows.append((word, n, form, start, end))
            yield pd.DataFrame(rows, columns=["word", "n", "form", "start", "end"])

    return run


def misread_words(words: DataFrame) -> DataFrame:
    """(word, good): rare words and the vocabulary word they are misread from.

    One misreading: the word with it undone is a known word. Two: the word with
    one undone is a known word with one made, at another place; so both sides
    are spelled once and joined, whatever the number of places.
    """
    letters = F.length(F.regexp_replace("word", r"[^\p{L}]", ""))
    counted = words.select("word", "n", F.length("word").alias("size"), letters.alias("letters")).filter("size >= 3 and letters >= 2").filter(~F.contains(F.col("word"), F.lit("-")))
    mixed = (F.col("letters") < F.col("size")) | F.contains(F.col("word"), F.lit("ьi"))
    counted = counted.withColumn("mixed", mixed).filter(F.when(F.col("mixed"), F.col("letters") >= 0.5 * F.col("size")).otherwise(F.col("size") >= 4))
    known = words.filter("n >= 2").filter(F.replace("word", F.lit("-"), F.lit("")).rlike(r"^\p{L}+$"))
    # a correction is at most two letters shorter or longer, so much longer words have none
    longest = known.agg(F.max(F.length("word"))).first()[0] or 0
    asked = cut_lineage(counted.filter(F.col("size") <= longest + 2).select("word", "n").mapInPandas(_pairs_of_forms(True), _FORMS), "asked")
    enough = F.when(F.col("mixed"), F.greatest(F.col("n"), F.lit(2))).otherwise(F.col("n") * RARE_BESIDE)
    facts = counted.select("word", "mixed")
    once = asked.select("word", "n", "form").join(known.select(F.col("word").alias("form"), F.col("n").alias("n_good")), "form").select("word", "n", F.col("form").alias("good"), "n_good")
    made = known.select("word", "n").mapInPandas(_pairs_of_forms(False), _FORMS).select(F.col("word").alias("good"), F.col("n").alias("n_good"), "form", F.col("start").alias("s"), F.col("end").alias("e"))
    twice = asked.join(made, "form").filter("end <= s or e <= start").select("word", "n", "good", "n_good")
    hit = once.unionByName(twice).filter("n_good >= n and word <> good").join(facts, "word").filter(F.col("n_good") >= enough)
    return hit.groupBy("word").agg(F.max(F.struct("n_good", "good"))["good"].alias("good"))


_FORMS = "word string, n bigint, form string, start int, end int"


def _all_events(texts: DataFrame, misread: DataFrame) -> DataFrame:
    """Distinct (field, row_id, key, noise, question); key tells rows of one id apart."""
    spark = texts.sparkSession
    total = misread.count()
    blocks = max(1, -(-total // BLOCK))
    out = None
    for b in range(blocks):
        own = misread if blocks == 1 else misread.filter(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b)
        held = own.toArrow()  # about BLOCK words
        sent = spark.sparkContext.broadcast(dict(zip(held.column("word").to_pylist(), held.column("good").to_pylist())))
        first = b == 0

        def run(batches: Iterator[pa.RecordBatch], sent=sent, first=first) -> Iterator[pa.RecordBatch]:
            words = sent.value
            for batch in batches:
                at: list[int] = []
                noise: list[str] = []
                question: list[str] = []
                good: list[str | None] = []
                for i, text in enumerate(batch.column(3).to_pylist()):
                    for kind, what in events(text, words, first):
                        at.append(i)
                        noise.append(kind)
                        question.append(what)
                        good.append(words[what] if kind == "misread" else None)
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in range(3)), pa.array(noise, pa.string()), pa.array(question, pa.string()), pa.array(good, pa.string())], names=["field", "row_id", "key", "noise", "question", "good"])

        part = texts.select("field", "row_id", F.xxhash64("text").alias("key"), "text").mapInArrow(run, "field string, row_id string, key bigint, noise string, question string, good string")
        out = part if out is None else out.unionByName(part)
    return out


def scan_noise(fields: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Noise of every text, confirmed by the corpus: (field, row_id, key, noise, question, good).

    question is the word or line in question, good the printed word of a misread
    one. Defined results: null, empty and blank texts have no noise; rows of the
    same id are told apart by the hash of their text (key); a text of one line
    has misread words only; empty tables give no rows.
    """
    texts = _texts(fields)
    words = cut_lineage(count_words(texts), "words")
    misread = cut_lineage(misread_words(words), "misread")
    found = cut_lineage(_all_events(texts, misread), "noise")
    sure = found.filter("noise = 'misread' or question = ''")
    # a compound that the corpus writes with its hyphen, and more often than joined, is no broken word
    asked = found.filter("noise = 'hyphenation' and question <> ''")
    terms = asked.select("question").distinct().withColumn("joined", F.replace("question", F.lit("-"), F.lit("")))
    terms = terms.join(words.select(F.col("word").alias("question"), F.col("n").alias("n_hyphen")), "question").join(words.select(F.col("word").alias("joined"), F.col("n").alias("n_joined")), "joined", "left")
    compounds = terms.filter("n_hyphen > coalesce(n_joined, 0)").select("question")
    broken = asked.join(compounds, "question", "left_anti")
    # a line of mixed letters is a heading where it stands at the page edges of several texts
    lines = found.filter("noise = 'running_header' and question <> ''")
    headings = lines.groupBy("question").agg(F.count_distinct("field", "row_id").alias("texts")).filter(F.col("texts") >= HEADING_TEXTS).select("question")
    confirmed = lines.join(headings, "question", "left_semi")
    names = found.columns
    return sure.select(names).unionByName(broken.select(names)).unionByName(confirmed.select(names)).unionByName(
        asked.join(compounds, "question", "left_semi").select("field", "row_id", "key", F.lit("compound").alias("noise"), "question", "good")
    )


def noisy_texts(fields: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(field, row_id, noise), each once."""
    return scan_noise(fields).filter("noise <> 'compound'").select("field", "row_id", "noise").distinct()


def repaired_texts(fields: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(field, row_id, text, repaired): every row of the fields with its text in continuous paragraphs.

    Null texts stay null, blank ones become empty; texts without noise only
    lose their line breaks within paragraphs.
    """
    noise = scan_noise(fields)
    told = noise.groupBy("field", "row_id", "key").agg(
        F.map_from_entries(F.collect_set(F.when(F.col("noise") == "misread", F.struct("question", "good")))).alias("misread"),
        F.collect_set(F.when(F.col("noise") == "compound", F.col("question"))).alias("keep"),
        F.collect_set(F.when((F.col("noise") == "running_header") & (F.col("question") != ""), F.col("question"))).alias("known"),
    )
    rows = None
    for name, df, id_col, text_col in fields:
        part = df.select(F.lit(name).alias("field"), F.col(id_col).cast("string").alias("row_id"), F.col(text_col).alias("text"))
        rows = part if rows is None else rows.unionByName(part)
    told = told.withColumnsRenamed({"field": "f", "row_id": "r", "key": "k"})
    joined = rows.withColumn("key", F.xxhash64("text")).join(told, (F.col("field") == F.col("f")) & F.col("row_id").eqNullSafe(F.col("r")) & (F.col("key") == F.col("k")), "left")

    @F.pandas_udf("string")
    def mend(text: pd.Series, misread: pd.Series, keep: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([repair(t, dict(m) if m is not None else {}, k if k is not None else (), h if h is not None else ()) for t, m, k, h in zip(text, misread, keep, known)], dtype=object)

    return joined.select("field", "row_id", "text", mend("text", "misread", "keep", "known").alias("repaired"))

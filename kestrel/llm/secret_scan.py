"""Secret scan: fixed patterns, and guess-cost dynamic programming on credential-context values.

The method judges every value that stands after a credential word and ``:`` or ``=``: the cheapest
segmentation of the value into words, dates, repeats, keyboard walks, placeholders and brute-force spans
gives the number of guesses (in bits) that it resists; from ``MIN_BITS`` on it is reported as a
``credential`` span, unless a base span already covers part of it.  ``changeme``, ``password123`` or
``${DB_PASSWORD}`` are cheap to guess and left alone.

A word takes as many guesses as its place in a ranked dictionary: a short list of password and placeholder
words, or the ``DICTIONARY`` most frequent words of the scanned texts themselves, whichever place is lower.
Spark counts all words of all texts; the driver gets the dictionary's rows only, and they travel with the tasks.

Defined cases: null and empty texts have no spans (hash of the empty string); spans are code points,
end exclusive, in order of start, then kind as listed; repeated rows are scanned one by one; words of
equal count rank by spelling; other columns are ignored; an empty table gives an empty result.  The scan is a narrow projection over
whole texts; time and memory per value are linear in its length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bytesvec import lean
from kestrel.llm.common import bounded_batches
from kestrel.session import Scratch

KINDS = ("assign", "access", "hex", "credential")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

# Fixed values of the contract: the base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Credential contexts of the method; wider than the base pattern, values of six characters and more.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|auth|bearer|credentials?|pin"""
    r"""|(?:api|access|private|secret|client)[_-]?(?:key|secret|token))["']?\x20*[:=]\x20*["']?([^\s"'<>,;|]{6,})""",
    re.I | re.A)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "auth", "bearer", "credential", "pin", "key")

#: Values that take at least so many bits of guesses are secrets.
MIN_BITS = 30.0
#: Longest walk or repeat that is tried from every place; longer ones are tried from a run's first places or to its end.
MAX_SEGMENT = 32

#: Common words of passwords and placeholders, most common first (the place is the number of guesses).
WORDS = """password qwerty admin welcome login letmein dragon monkey master shadow sunshine princess football baseball
superman batman trustno hello freedom whatever secret token access pass test user guest root default change changeme
example sample demo dummy placeholder insert your here value none null true false string text name key api auth
summer winter spring autumn monday friday january june july august october december love life house home work
office company server database private public local host production staging dev prod system service account
the and for with this that from have not you are was all can but one two three new old big small red blue green
black white gold silver star moon sun fire water earth cat dog horse tiger lion eagle bear wolf fox bird fish
apple orange banana cherry coffee cookie cheese pepper ginger hunter soccer hockey killer ninja pirate robot
computer internet google windows linux abc xyz foo bar baz redacted required optional masked hidden removed
replace replaced variable environment documentation undefined unknown missing invalid expired enabled disabled
empty number boolean integer config settings provided specified generated encrypted""".split()
RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys(WORDS))}
#: Words that the dictionary takes from the texts, the most frequent ones; it bounds what the driver and a task hold.
DICTIONARY = 20_000
#: Times that a word must occur.
LEAST = 3
#: Letters of a word of the dictionary.
WORD_LENGTHS = range(3, 25)
LEET = str.maketrans("013457@$!", "oieastasi")

ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
PLACE = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
SEP = "[-/._]?"
DAY, MONTH, YEAR = "(?:0[1-9]|[12][0-9]|3[01])", "(?:0[1-9]|1[0-2])", "(?:19|20)[0-9][0-9]"
#: Dates by form, with the bits of their guesses.
DATES = ((re.compile(YEAR), math.log2(130)), (re.compile(YEAR + SEP + MONTH + SEP + DAY), math.log2(130 * 366)),
         (re.compile(DAY + SEP + MONTH + SEP + YEAR), math.log2(130 * 366)))
#: What stands for a value that is elsewhere: references to variables, settings and stores.
PLACEHOLDER = re.compile(
    r"""\$\{[^}]{0,64}\}|\$\([^)]{0,64}\)|\{\{[^}]{0,64}\}\}|\[[A-Za-z_-]{1,64}\]|%[A-Za-z_]{3,64}%|\$[A-Z][A-Z_]{2,64}"""
    r"""|(?:your|insert|replace|enter)(?:[_-][A-Za-z]{1,32}){1,8}"""
    r"""|(?:process\.env|os\.environ|os\.getenv|System\.getenv|getenv|env|secrets|vault|config|settings)"""
    r"""(?:\.[A-Za-z_]{1,64}|\[[A-Za-z_]{1,64}\]|\([A-Za-z_]{0,64}\)?){1,8}""", re.A)
PLACEHOLDER_BITS = 6.0


def adjacent(a: str, b: str) -> bool:
    """Keys that touch on the keyboard (the same key does not count), or neighbours in the alphabet."""
    if a in PLACE and b in PLACE:
        (r, k), (s, m) = PLACE[a], PLACE[b]
        if (r, k) != (s, m) and abs(r - s) <= 1 and abs(k - m) <= 1:
            return True
    return a.isascii() and b.isascii() and a.isalpha() and b.isalpha() and abs(ord(a) - ord(b)) == 1


def char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isalpha():
        return math.log2(26) if c.islower() or not c.isascii() else math.log2(26) + 0.5
    return math.log2(33)


def lengths(first: int, whole: int, inside: int) -> list[int]:
    """Lengths of the segments from a place of a run, ``inside`` places after its first, with ``whole`` left of it.

    All from the run's first places, elsewhere the short ones and the whole rest: a segment that begins further
    inside and ends inside is dearer than one from the run's first places, as cost grows with the logarithm of length."""
    if inside <= MAX_SEGMENT or whole <= MAX_SEGMENT:
        return list(range(first, whole + 1))
    return [*range(first, MAX_SEGMENT + 1), whole]


def word_ranks(docs: DataFrame, text: str = "text", size: int = DICTIONARY, least: int = LEAST) -> dict[str, int]:
    """The dictionary: place by word of the ``size`` most frequent words of all texts, and of ``WORDS``.

    Words go in by classes of equal count (within 1/16 from 32 on), most frequent first, as far as whole classes fit: the
    driver reads one row per class and then the words themselves, never more than ``size`` and none per task or partition.
    Values behind credential words do not count, so that no secret vouches for itself, however often it was copied."""
    prose = F.regexp_replace(F.col(text), "(?i)" + CONTEXT.pattern, " ")
    word = F.explode(F.split(F.lower(prose), "[^a-z]+")).alias("word")
    counts = (docs.select(word).filter(F.length("word").between(WORD_LENGTHS[0], WORD_LENGTHS[-1]))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least))
    with Scratch(docs.sparkSession) as scratch:
        counts = scratch.materialize(counts, "secret-words")
        size_class = F.expr("length(bin(n)) * 32 + (n >> greatest(length(bin(n)) - 5, 0))").alias("class")
        classes = counts.groupBy(size_class).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("low")).collect()
        held, cut = 0, None
        for c in sorted(classes, key=lambda c: -c.low):
            held += c.words
            if held > size:
                break
            cut = c.low
        top = counts.filter(F.col("n") >= cut).collect() if cut is not None else []
    top.sort(key=lambda r: (-r.n, r.word))
    ranks = {r.word: i + 1 for i, r in enumerate(top)}
    return {w: min(ranks.get(w, i), RANK.get(w, i)) for w, i in (ranks | RANK).items()}


def guess_bits(value: str, ranks: dict[str, int] = RANK) -> float:
    """log2 of the guesses of the cheapest segmentation; every segment costs one more bit for its kind."""
    n, low = len(value), value.lower()
    if len(low) != n:  # a few capitals change length when lowered
        low = value
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n

    def offer(end: int, bits: float) -> None:
        if bits < best[end]:
            best[end] = bits

    runs = [0] * n  # walk length from each start, filled backwards
    same = [[0] * (n + 1) for _ in range(5)]  # by unit: characters from each start that equal the one a unit further
    for i in range(n - 1, -1, -1):
        runs[i] = runs[i + 1] + 1 if i + 1 < n and adjacent(low[i], low[i + 1]) else 1
        for unit in (1, 2, 3, 4):
            same[unit][i] = same[unit][i + 1] + 1 if i + unit < n and value[i] == value[i + unit] else 0
    walked = 0  # steps since the walk's first place; the same by unit
    since = [0] * 5
    for i in range(n):
        at = best[i] + 1
        offer(i + 1, best[i] + char_bits(value[i]))
        for length in WORD_LENGTHS[:max(0, n - i - WORD_LENGTHS[0] + 1)]:
            piece = low[i:i + length]
            rank = ranks.get(piece)
            extra = 0.0 if value[i:i + length] == piece else 1.0
            if rank is None:
                rank, extra = ranks.get(plain[i:i + length]), extra + 1.0
            if rank is not None:
                offer(i + length, at + math.log2(rank + 1) + extra)
        for form, bits in DATES:
            if m := form.match(value, i):
                offer(m.end(), at + bits)
        if m := PLACEHOLDER.match(value, i):
            offer(m.end(), at + PLACEHOLDER_BITS)
        walked = walked + 1 if i and runs[i - 1] > 1 else 0
        for length in lengths(3, runs[i], walked):
            offer(i + length, at + math.log2(len(PLACE)) + 1.5 * math.log2(length))
        for unit in (1, 2, 3, 4):
            since[unit] = since[unit] + 1 if i and same[unit][i - 1] else 0
            if same[unit][i] < unit:
                continue
            bits = at + sum(map(char_bits, value[i:i + unit]))
            for k in lengths(3 if unit == 1 else 2, 1 + same[unit][i] // unit, since[unit]):
                offer(i + k * unit, bits + math.log2(k))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


def credential_spans(text: str, base: list[tuple[int, int, str]],
                     ranks: dict[str, int] = RANK) -> list[tuple[int, int, str]]:
    if ":" not in text and "=" not in text:
        return []
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        if not any(s < end and start < e for s, e, _ in base) and guess_bits(m[1], ranks) >= MIN_BITS:
            out.append((start, end, "credential"))
    return out


def spelled(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, text: str = "text", dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_credential, base_sha256, spans."""
    bounded_batches(docs.sparkSession)
    ranks = word_ranks(docs, text, dictionary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            counts: list[list[int]] = [[], [], [], []]
            shas, spans = [], []
            for t in batch.column(1).to_pylist():
                base = base_spans(t or "")
                more = credential_spans(t or "", base, ranks)
                for kind, out in zip(KINDS, counts):
                    out.append(sum(s[2] == kind for s in base + more))
                shas.append(hashlib.sha256(spelled(base).encode()).hexdigest())
                spans.append(spelled(sorted(base + more, key=lambda s: (s[0], ORDER[s[2]]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()),
                 pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_credential", "base_sha256", "spans"])

    return docs.select("doc_id", text).mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, n_credential long, base_sha256 string, spans string")


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

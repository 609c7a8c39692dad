"""Secret scan: fixed patterns, and password guess cost for values in a credential context.

Base kinds (their matches always stay): ``assign``, a credential keyword with a value of 12 characters or
more; ``access``, an access key id; ``hex``, a run of 16 or more hexadecimal digits. Kind ``guess`` adds
values of a credential context that the patterns leave out (other keywords, shorter values, other
characters) when guessing them is costly: the value is cut, by dynamic programming, into the cheapest
sequence of known words, dates, repeats, keyboard walks and brute-force spans, and the decimal logarithm
of the guesses for that sequence must reach ``LEAST_COST``. Ordinary words after a keyword stay below it.
"""

import base64
import json
import math
import re
from collections.abc import Callable, Iterator
from itertools import zip_longest
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import LOWER, id_text, map_batches, slices, with_fields

KINDS = ("assign", "access", "hex", "guess")
LEAST_COST, LEAST_VALUE = 8.0, 6
#: Values whose price is kept (all go when full), the longest of them, and how far from a run's end, or from its start, spans begin in it.
KNOWN, LONGEST_KNOWN, NEAR = 50_000, 64, 64
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the run is maximal, so 18 characters or none
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORD = r"(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|api[_-]?key|credentials?)"
SETS = r"""["']?[\x20\t]*(?:=>|[:=])"""
#: An unquoted value ends where a separator and the next credential keyword follow, as in URL queries and connection strings.
CONTEXT = re.compile(rf"""(?<![A-Za-z0-9])({KEYWORD}){SETS}[\x20\t]*(?:(["'`])([^\s"'`<>]{{6,}})|((?:(?!(?:&amp;|[&;,])["']?{KEYWORD}{SETS})[^\s"'`<>]){{6,}}))""", re.I | re.A)
KEYWORDS = (b"pass", b"pwd", b"secret", b"token", b"api", b"credential")
HEX_MAP = bytes(104 if 48 <= c <= 57 or 97 <= c <= 102 else 32 for c in range(256))

#: Common passwords and password words, most common first.
WORDS = (
    "password qwerty admin welcome letmein monkey dragon football baseball master login princess sunshine shadow superman "
    "iloveyou trustno access hello flower passw0rd michael jordan hunter batman soccer charlie donald freedom whatever ninja "
    "mustang secret killer george summer winter spring autumn computer internet cheese pepper orange banana ginger cookie "
    "thomas robert daniel andrew joshua jessica ashley nicole hannah amanda maggie buster tigger matrix starwars pokemon "
    "google test guest root user default changeme example sample demo temp none null required token value string pass love "
    "angel blue green black white silver gold magic money happy lucky power system server service client public private key "
    "your here the and for with not see set get env config"
).split()
#: Rows of a keyboard, the alphabet and the digits.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp", "0123456789")
#: What other languages write after a keyword, as the vocabularies hold few of their long words.
PHRASES = (
    "obligatoire requis requise oublié oubliée invalide incorrecte utilisateur identifiant confirmer nécessaire protégé modifier contraseña requerido requerida obligatorio obligatoria "
    "olvidada olvidado usuario incorrecta protegido protegida inválida confirmar necesario passwort kennwort benutzer benutzername erforderlich vergessen ungültig falsch geschützt "
    "bestätigen notwendig eingeben ändern obbligatorio richiesto dimenticata utente obrigatório senha usuário verplicht vereist wachtwoord gebruiker"
).split()
NEXT = {(a, b) for row in WALKS for r in (row, row[::-1]) for a, b in zip(r, r[1:], strict=False)}
DATE = re.compile(r"(?:(?:19|20)\d\d[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)?\d\d|(?:19|20)\d\d)", re.A)
LEET = str.maketrans("01345@$7", "oieasast")
#: Decimal logarithm of the guesses for a character that no other span explains: the size of its class. Letters beyond
#: ASCII are priced like letters of prose, as the word list has few words of their scripts.
PER_CHAR = {"lower": math.log10(26), "digit": 1.0, "upper": math.log10(26), "other": 1.5, "prose": 0.7}


def char_cost(c: str) -> float:
    return PER_CHAR["prose" if not c.isascii() and c.isalpha() else "lower" if c.islower() else "digit" if c.isdigit() else "upper" if c.isupper() else "other"]


def vocabulary_words(path: str) -> list[str]:
    """Whole words of four letters or more, with a vowel, of a public tokenizer's vocabulary, most common first.

    ``.json``: tokens with the mark of a word's end, over the byte alphabet; ``.tiktoken``: tokens with a space before them.
    """
    if path.endswith(".json"):
        vocabulary = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        found = [bytes(byte[c] for c in t[:-4]) for t in sorted(vocabulary, key=vocabulary.get) if t.endswith("</w>")]
    else:
        ranked = sorted((int(n), base64.b64decode(t)) for t, n in map(bytes.split, Path(path).read_bytes().splitlines()))
        found = [t[1:] for _, t in ranked if t[:1] == b" "]
    words = (t.decode("utf-8", "replace").lower() for t in found)
    has_vowel = lambda w: any(c in "aeiouy" or not c.isascii() for c in w)
    return list(dict.fromkeys(w for w in words if len(w) >= 4 and w.isalpha() and has_vowel(w)))


class Guesser:
    """Prices values. Words rank by the fixed lists, then by the vocabularies of ``paths``, taken in turns."""

    def __init__(self, paths: tuple[str, ...] = ()):
        more = [w for row in zip_longest(*map(vocabulary_words, paths)) for w in row if w]
        self.rank = {w: i + 1 for i, w in enumerate(dict.fromkeys([*WORDS, *PHRASES, *more]))}
        self.longest = max(map(len, self.rank))
        self.known: dict[str, float] = {}

    def cost(self, value: str) -> float:
        """Decimal logarithm of the guesses for ``value``: the least sum over all cuts into spans; in one case throughout, at most one guess more than the other case."""
        if (found := self.known.get(value)) is None:
            found, low = self._least(value), value.lower()
            if value.isupper() and low != value:
                found = min(found, self._least(low) + math.log10(2))
            if len(self.known) >= KNOWN:
                self.known.clear()
            if len(value) <= LONGEST_KNOWN:
                self.known[value] = found
        return found

    def _least(self, value: str) -> float:
        n, low = len(value), value.lower()
        if len(low) != n:
            low = value
        plain = low.translate(LEET)
        best = [0.0] + [math.inf] * n
        walk, same = runs(n, lambda i: (low[i], low[i + 1]) in NEXT), runs(n, lambda i: value[i] == value[i + 1])
        for i in range(n):
            b, c = best[i], char_cost(value[i])
            best[i + 1] = min(best[i + 1], b + c)
            for k in range(3, min(self.longest, n - i) + 1):
                rank = self.rank.get(low[i : i + k])
                leet = rank is None and (rank := self.rank.get(plain[i : i + k])) is not None
                if rank:
                    best[i + k] = min(best[i + k], b + math.log10(rank + 1) + 0.3 * (value[i : i + k] != low[i : i + k]) + 0.3 * leet)
            for (ahead, behind), own in ((walk[i], 1.4), (same[i], c)):
                # A start deep inside a run is cheaper only for a short rest: what covers the run so far costs more than the longer count.
                for k in range(3, min(ahead, math.inf if behind < NEAR else NEAR) + 1):
                    best[i + k] = min(best[i + k], b + own + math.log10(k))
            if value[i].isdigit():
                for k in range(4, min(10, n - i) + 1):
                    if DATE.fullmatch(value, i, i + k):
                        best[i + k] = min(best[i + k], b + math.log10(365 * 120 if k > 4 else 120))
        return best[n]


def runs(n: int, goes_on: Callable[[int], bool]) -> list[tuple[int, int]]:
    """For every place: characters of the run from there on, and of the same run before it."""
    ahead, behind = [1] * n, [0] * n
    for i in range(n - 2, -1, -1):
        ahead[i] = ahead[i + 1] + 1 if goes_on(i) else 1
    for i in range(1, n):
        behind[i] = behind[i - 1] + 1 if ahead[i - 1] > 1 else 0
    return list(zip(ahead, behind, strict=True))


def scan(text: str, guess: Guesser) -> list[tuple[int, int, int, float | None]]:
    """(start, kind number, end, guess cost) of every span, in order; code points, end exclusive."""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans: list[tuple[int, int, int, float | None]] = [(*x, None) for x in sorted(base)]
    taken, k = sorted((a, b) for a, _, b in base), 0
    for m in CONTEXT.finditer(text):
        own = 3 if m[2] else 4
        a, b = m.span(own)
        value = m[own]
        if not m[2]:
            value = value.rstrip(".,;:!?)]}")
            b = a + len(value)
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if len(value) >= LEAST_VALUE and not any(x < b for x, _ in taken[k : k + 1]) and (cost := guess.cost(value)) >= LEAST_COST:
            spans.append((a, 3, b, cost))
    return sorted(spans, key=lambda x: x[:3])


def worth_a_scan(text: bytes) -> bool:
    """False only where no pattern can match; a few searches for bytes."""
    if b"AKIA" in text or b"h" * 16 in text.translate(HEX_MAP):
        return True
    if b":" in text or b"=" in text:
        low = text.translate(LOWER)
        return any(k in low for k in KEYWORDS)
    return False


SPANS = "array<struct<kind:string,start:long,end:long,log10_guesses:double>>"


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), vocabularies: tuple[str, ...] = ()) -> DataFrame:
    """(id, spans[, the columns of ``keep``]) for every row of ``df``, spans in order of start, then kind.

    ``vocabularies``: files of public tokenizers, read at the driver, whose words count as known besides the fixed lists.

    Null and empty texts have no spans; very long texts are scanned whole; spans of different kinds may
    overlap, as a hexadecimal value of a keyword does; rows repeated under one id are rows of their own;
    an empty table gives an empty result; other columns are ignored unless named in ``keep``.
    """
    guess = Guesser(vocabularies)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, texts in slices(batch):
                found = [[{"kind": KINDS[k], "start": a, "end": b, "log10_guesses": c} for a, k, b, c in scan(t.decode("utf-8", "replace"), guess)] if t and worth_a_scan(t) else [] for t in texts]
                rest = [c.slice(done, len(ids)) for c in batch.columns[2:]]
                done += len(ids)
                yield pa.record_batch([ids, pa.array(found, kind), *rest], ["id", "spans", *keep])

    own = id_text(df, id_col, text_col, keep)
    return map_batches(own, run, with_fields(f"id long, spans {SPANS}", own.schema.fields[2:]))


def joined(spans: Column) -> Column:
    """kind:start:end of spans, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != "guess")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every stretch that spans cover replaced by ``mark``."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, text_col: str = "text", size_col: str = "n_chars", vocabularies: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the spans of every text replaced by a mark, and the size of changed texts put right.

    All rows and columns stay, whatever their names, and rows without a span as they were: null texts, empty ones,
    texts without secrets; very long texts are scanned whole; repeated rows stay repeated; an empty table gives an
    empty result; a null size of a changed text becomes its size. ``vocabularies`` as for ``secret_spans``.
    """
    names, guess = df.columns, Guesser(vocabularies)
    where = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).cast(pa.large_binary())
            changed: dict[int, str] = {}
            for i in range(len(texts)):
                raw = texts[i].as_py()
                if raw and worth_a_scan(raw):
                    text = raw.decode("utf-8", "replace")
                    if found := scan(text, guess):
                        changed[i] = redact(text, [(a, b) for a, _, b, _ in found])
            columns = batch.columns
            if changed:
                mask = pa.array([i in changed for i in range(len(texts))])
                columns[where] = pc.replace_with_mask(columns[where], mask, pa.array(list(changed.values()), columns[where].type))
                if size_col in names:
                    k = names.index(size_col)
                    columns[k] = pc.replace_with_mask(columns[k], mask, pa.array([len(t) for t in changed.values()], columns[k].type))
            yield pa.record_batch(columns, names)

    return map_batches(df, run, df.schema)

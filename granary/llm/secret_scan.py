"""Secret scans: patterns, and the novelty that a string adds under a primed compressor.

Zstandard, primed with a dictionary of code and identifiers, compresses what surrounds a candidate, and
then the same with the candidate. The difference is what the candidate adds. Names, paths, words and
repetitions add little; keys add nearly all of their entropy. A candidate in a sensitive context that adds
enough for each of its characters is reported, at each place where it stands in the text.
"""

from __future__ import annotations

import re
from base64 import b64encode
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import by_position, small_batches

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A sensitive word; and one that is common in prose too, and counts only right before a value that is assigned to it.
CONTEXT = re.compile(r"(?:passphrase|passwd|password|pwd|secret|token|credential|api[ _-]?key|private[ _-]?key|access[ _-]?key|auth[ _-]?key|bearer|authorization)", re.IGNORECASE | re.ASCII)
ASSIGNED = re.compile(r"""(?:(?<![A-Za-z])(?:key|auth|pass|pw|sig|signature))["']?[\x20\t]*[:=]""", re.IGNORECASE | re.ASCII)
#: What is sensitive by its form: the password of a URL, and a token of three parts, the first two of which are JSON in base64.
URL_PASSWORD = re.compile(r"://[^\s/:@]{0,256}:([^\s/@]{4,1024})@")
SIGNED_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
#: What lies between a sensitive word and the value that is assigned to it.
EQUALS = re.compile(r"""["']?\s{0,8}(?:[:=]|=>|:=)\s{0,8}["']?""")
#: A candidate is a run of printable ASCII without white space and quotes, less what opens and closes it in prose, or a field of such a run.
RUN, FIELD = re.compile(r"""[^\s"'`]+"""), re.compile(r"[^=:&?,;<>(){}\[\]|]+")
OPENS, CLOSES = "([{<", ".,;:!?)]}>"
#: Characters of the shortest candidate; of one with fewer than three kinds of characters; of one with a single kind.
SHORTEST, TWO_KINDS, ONE_KIND = 8, 10, 16
#: Names, paths, hosts, mail addresses, dates and numbers: pieces between signs, each a word in any case with at most a short number, or a
#: short number. No piece's word has more letters than words of identifiers have.
PIECE = re.compile(r"(?:[A-Z]{1,15}|[A-Z]{0,6}[a-z]{2,15}(?:(?:[A-Z][a-z]{2,15}|Id|Of|To|In|Is|By|On|Or|At|Up|No)+[A-Z]{0,6})?|[a-z])[0-9]{0,4}[a-z]{0,2}|[0-9]{1,6}(?:[a-zA-Z]{1,2}[0-9]{0,2})?")
PLACES = ("${", "{{", "$(", "%(", "<")
SIGNS = re.compile(r"[^A-Za-z0-9]+")
#: How far behind a sensitive word, or behind a secret that was found there, a candidate may begin, over lines; and the characters
#: on either side that count as its surroundings.
REACH, AROUND = 128, 1024
#: Bytes of novelty for each character. What matches nothing costs some three quarters, whatever it is made of; repetitions and words
#: of the surroundings or the dictionary cost less.
NOVELTY = 0.5
#: Stands before all that is compressed: characters of all kinds, by a rule. Whatever a candidate is made of, a character that matches
#: nothing costs about the same behind it; without it, digits would cost half of what letters do.
FLOOR = b64encode(b"".join(sha256(bytes([k])).digest() for k in range(14)))
#: Common words of code, configuration and keys, most common last, where zstandard matches cheapest.
DICTIONARY = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 lorem ipsum example placeholder changeme your_api_key_here xxxxxxxxxxxxxxxx 0000000000000000 1234567890123456 "
    "import from include package namespace public private protected static final class struct interface function return const let var def self this null None true false if else for while try except catch throw raise new delete void int float double string bool char byte array list dict map "
    "http:// https:// localhost 127.0.0.1 .com .org .net /usr/local/bin /home/user /var/log index.html config.yaml settings.json README.md Makefile Dockerfile "
    "username user_id session_id client_id client_secret access_token refresh_token api_key apikey secret_key private_key public_key password passwd token secret authorization bearer credential environment "
    "get_value set_value create_user update_record delete_item load_config parse_args read_file write_file connection request response header content_type application/json timeout retry default version enabled "
).encode()

_ZSTD: list = []


def novelty(text: str, start: int, end: int) -> float:
    """Bytes for each character that text[start:end] adds to its surroundings under the primed compressor. Other copies
    of it do not count as surroundings: a key that stands twice is as new as one that stands once."""
    import zstandard

    if not _ZSTD:
        primed = zstandard.ZstdCompressionDict(DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _ZSTD.append(zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False))
    word = text[start:end]
    before, after = text[max(0, start - AROUND - len(word)) : start], text[end : end + AROUND + len(word)]  # no copy is cut
    before, after = before.replace(word, " "), after.replace(word, " ")
    around = FLOOR + (before[-AROUND:] + after[:AROUND]).encode()
    return (len(_ZSTD[0].compress(around + word.encode())) - len(_ZSTD[0].compress(around))) / (end - start)


def named(word: str) -> bool:
    """Whether a run is put together as names, paths, addresses, dates and numbers are: of pieces that are not all short, with few
    signs between them; or is a place for a value."""
    if word.startswith(PLACES):
        return True
    pieces, signs = [x for x in SIGNS.split(word) if x], [c for c in word if not c.isalnum()]
    if len(set(signs)) >= 3 and 4 * len(signs) >= len(word):
        return word.startswith(("http", "/", "--"))
    return len(word) >= 3 * len(pieces) and all(PIECE.fullmatch(x) for x in pieces)


def measured(word: str, next_to: bool = True) -> bool:
    """Whether a run may be a secret, so that its novelty decides: printable ASCII, no name, and the longer the fewer kinds of
    characters it has. Lower case, upper case, digits and signs are kinds. A word of letters in one case, as long ones of some languages
    are, counts only right behind the sensitive word."""
    if len(word) < SHORTEST or not word.isascii() or not word.isprintable():
        return False
    if not next_to and word.isalpha() and (word.isupper() or word[1:].islower()):
        return False
    kinds = any(map(str.islower, word)) + any(map(str.isupper, word)) + any(map(str.isdigit, word)) + (not word.isalnum())
    return len(word) >= (ONE_KIND if kinds == 1 else TWO_KINDS if kinds == 2 else SHORTEST) and not named(word)


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A run without what opens and closes it in prose."""
    while start < end and text[start] in OPENS:
        start += 1
    while end > start and text[end - 1] in CLOSES:
        end -= 1
    return start, end


def parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The spans of a run that may be secrets: its fields, the longest first, then all of it."""
    start, end = trimmed(text, start, end)
    fields = [m.span() for m in FIELD.finditer(text, start, end) if m.end() - m.start() >= SHORTEST]
    yield from sorted(fields, key=lambda x: x[0] - x[1])
    if fields != [(start, end)] and end > start:
        yield start, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the base patterns find."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets in a text, in characters, by start and then by kind."""
    out = base_spans(text)
    base = sorted((s, e) for _, s, e in out)
    starts, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))  # the farthest end of all that start so far
    inside = lambda start, end: (k := bisect_right(starts, start)) > 0 and reach[k - 1] >= end
    novel: set[str] = set()
    spans: set[tuple[int, int]] = set()

    def secret(start: int, end: int, next_to: bool = True) -> bool:
        word = text[start:end]
        if inside(start, end) or not (word in novel or measured(word, next_to) and novelty(text, start, end) >= NOVELTY):
            return False
        novel.add(word)
        spans.add((start, end))
        return True

    seen = 0
    words = sorted([(m.end(), True) for m in CONTEXT.finditer(text)] + [(m.end(), False) for m in ASSIGNED.finditer(text)])
    for behind, strong in words:
        value = EQUALS.match(text, behind).end() if strong and EQUALS.match(text, behind) else None
        if not strong:
            value = behind + len(re.match(r"""\s{0,8}["']?""", text[behind : behind + 10])[0])
        low, last, first = max(seen, behind), behind + (REACH if strong else value - behind), True
        while low <= last and (run := RUN.search(text, low, last + 1)):
            start = run.start()
            while start > seen and start == behind and text[start - 1] not in " \t\n\r\f\v\"'`":  # the sensitive word may be the run's beginning
                start -= 1
                behind -= 1
            start, end = RUN.match(text, start).span()
            low, seen, next_to, first = end, end, first, False
            given = max(value, start) if value is not None and start <= value < end else None
            if given is not None:  # all of the value that is assigned, whatever signs it has
                stop = end
                while stop > given and text[stop - 1] in ",;":
                    stop -= 1
                if secret(given, stop):
                    last = end + REACH
                    continue
            for s, e in parts(text, start, end):
                if secret(s, e, next_to):
                    last = end + REACH  # a key may go on, line by line
                    if (s, e) == trimmed(text, start, end):
                        break
    for m in URL_PASSWORD.finditer(text):
        secret(*m.span(1))
    for m in SIGNED_TOKEN.finditer(text):
        secret(*m.span())
    for run in RUN.finditer(text) if novel else ():  # wherever it stands
        for s, e in parts(text, *run.span()):
            if text[s:e] in novel and not inside(s, e):
                spans.add((s, e))
    held = -1
    for s, e in sorted(spans, key=lambda x: (x[0], -x[1])):  # of spans in one another the outer
        if e > held:
            out.append(("novel", s, e))
            held = e
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and spans: array<struct<kind, start, end>> (code points, end exclusive) of each row's whole text.

    Beyond the base patterns a secret is looked for within REACH characters behind a sensitive word, over lines, and from
    each secret found on; in the password of a URL; and in signed tokens. Runs of printable ASCII that are not put together as names are,
    of 8 characters or more (10 with two kinds of characters, 16 with one), are secrets if their novelty says so.

    A null or empty text has no spans; null ids and repeated rows give a row each; an empty table gives an
    empty one. Other columns are not read. One row in, one row out, no shuffle.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(x)] if x else [] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    plain, (ident, text) = by_position(df, id_col, text_col)
    kind = plain.schema[ident].dataType.simpleString()
    return plain.select(ident, text).mapInArrow(run, f"id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>").withColumnRenamed("id", id_col)


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """df with each secret in its texts (overlapping ones as one) replaced by a mark. All other columns stay, whatever
    their names and types; a null text stays null, an empty one empty; null ids and repeated rows are rows like others; an empty table gives
    an empty one."""
    small_batches(df.sparkSession)
    plain, (text,) = by_position(df, text_col)
    at = plain.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for x in batch.column(at).to_pylist():
                spans = find(x) if x else []
                if spans:
                    parts, end = [], 0
                    for _, s, e in spans:
                        if s >= end:
                            parts += [x[end:s], mark]
                        end = max(end, e)
                    x = "".join(parts) + x[end:]
                out.append(x)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the SHA-256 of the base spans and all spans as text."""
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"] != "novel")
    return scanned.select(id_col, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), count("novel").alias("n_novel"))

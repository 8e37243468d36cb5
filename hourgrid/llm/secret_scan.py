"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is a run of token characters that holds a digit or eight capitals, any value that a word such as
``password`` names, or the user and password in an address. The forest sees its length and
composition, how likely its character transitions are in the corpus, how much of it words of the corpus cover, whether
it lies in a path or address, and the words beside it. Transitions and words are counted over all documents. The forest
is trained from labelled findings: given ones, and findings of the corpus whose form alone decides (``known_label``),
a bounded sample of them (``SAMPLE``).
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.session import scratch_path, stored

SAMPLE, TREES, DEPTH, SEED = 10_000, 40, 8, 17
LEAST_LENGTH = 12
#: Least length of a value that a neighbour word names.
NAMED_LENGTH = 6
DICTIONARY, DICTIONARY_WORD = 20_000, re.compile(r"[a-z]{3,12}")
#: A word of the dictionary is one in so many of all words at least.
ONE_IN = 100_000
#: Distinct words that a task counts before it passes their counts on.
COUNTED = 200_000
#: Up to how many findings are brought to the documents by broadcast.
BROADCAST_FINDINGS = 100_000

ANCHOR = re.compile(r"[0-9]|[A-Z]{8}")
RUN = re.compile(r"[A-Za-z0-9+/_\-.@:%=~]+")
# Words that stand beside a secret, and forms that decide by themselves.
NEIGHBOUR = re.compile(r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api|key|auth|bearer|credential|private|access)")
STEMS = "pass pwd secret token api key auth bearer credential private access".split()
#: From the end of a stem to the value that it names: by assignment, or after blanks.
TO_VALUE = re.compile(r"\w{0,40}[\"'`\])]{0,2}(?:\s{0,20}(?:=>|:=|={1,3}|:)\s{0,20}|[ \t]{1,20}(?:is[ \t]{1,20})?)(?P<quote>[\"'`]?)")
QUOTE_OR_BLANK = re.compile(r"[\s\"'`]")
ASSIGNED = re.compile(rf"{NEIGHBOUR.pattern}\w{{0,40}}[\"'`\])]{{0,2}}\s{{0,20}}(?:=>|:=|={{1,3}}|:)\s{{0,20}}[\"'`]?$")
FOLLOWS = re.compile(rf"{NEIGHBOUR.pattern}\w{{0,40}}[ \t]{{1,20}}(?:is[ \t]{{1,20}})?[\"'`]?$")
#: A value that is a name with a value of its own.
OWN_NAME = re.compile(rf"(?i)[\w.\-]{{0,40}}{NEIGHBOUR.pattern[4:]}[\w.\-]{{0,40}}[\"'`]?[=:]")
USER_INFO = re.compile(r"([^\s\"'`/?#]+)@")
ACCESS_KEY = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}")
HEX = re.compile(r"[0-9a-f]{16,}")
MAIL = re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}")
MARK = "[secret]"  # what stands for a secret in redacted texts
NUMBER = re.compile(r"[0-9.,:/+\-]+")
WORD = re.compile(r"[a-z]+|[A-Z]+|[A-Z][a-z]+")
ADDRESS = re.compile(r"[a-z]+://.*|/.*|(www\.).*")

FEATURES = (
    "length digits upper lower other transitions variety covered in_path mail word_before word_in_line assigned quoted named credentials"
).split()
FINDING = "doc_id long, text_hash long, start int, length int, kind string, known int, features array<double>"


def _value(run: str) -> tuple[int, int]:
    """Where the value of a run begins and ends: after ``name=`` or ``name:``, without closing stops."""
    start, end = 0, len(run.rstrip(".:,-"))
    m = re.match(r"[A-Za-z_][A-Za-z0-9_\-.]*[=:](?!/)", run)
    if m:
        start = m.end()
    return start, max(start, end)


def _credentials(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of ``user:password`` in addresses, and of a user that looks like a token."""
    at = text.find("://")
    while at >= 0:
        if m := USER_INFO.match(text, at + 3):
            user = m[1]
            if (":" in user and user[-1] != ":") or (len(user) >= LEAST_LENGTH and ANCHOR.search(user)):
                yield m.span(1)
        at = text.find("://", at + 3)


#: What ``_without_stops`` never takes from a value's end.
NO_STOP = re.compile(r"[^.,;:)\]}]")
PAIRS = {")": "(", "]": "[", "}": "{"}


def _without_stops(text: str, start: int, end: int) -> int:
    """The end of a value without closing stops and without brackets that it does not open."""
    open_ = {b: text.count(a, start, end) - text.count(b, start, end) for b, a in PAIRS.items()}
    while end > start:
        last = text[end - 1]
        if last in PAIRS and open_[last] < 0:
            open_[last] += 1
        elif last not in ".,;:":
            break
        end -= 1
    return end


class _Next:
    """The next place of something from a position on, for positions that only grow: each part of a text is read once."""

    def __init__(self, text: str, found: Callable[[int], int]):
        self.found, self.none, self.at = found, len(text) + 1, -1

    def __call__(self, start: int) -> int:
        if self.at < start:
            place = self.found(start)
            self.at = self.none if place < 0 else place
        return self.at


def _named(text: str, taken_to: int = 0) -> Iterator[tuple[int, int]]:
    """Start and end of the values that neighbour words name, up to the closing quote or white space, in order and apart."""
    low = text.lower()
    if len(low) != len(text):  # a few letters change their length
        low = "".join(c.lower() if c.isascii() else c for c in text)
    values: dict[int, str] = {}
    for stem in STEMS:
        at = low.find(stem)
        while at >= 0:
            at += len(stem)
            if m := TO_VALUE.match(text, at):
                values[m.end()] = m["quote"]
            at = low.find(stem, at)
    line = _Next(text, lambda i: text.find("\n", i))
    closing = {q: _Next(text, lambda i, q=q: text.find(q, i)) for q in "\"'`"}
    blank = _Next(text, lambda i: m.start() if (m := QUOTE_OR_BLANK.search(text, i)) else len(text))
    for start in sorted(values):
        if start < taken_to:
            continue
        end, quoted = -1, values[start]
        if quoted:
            end = closing[quoted](start)
            end = -1 if end > len(text) or line(start) < end else end
        closed = end >= 0
        end = end if closed else blank(start)
        decided = ACCESS_KEY.match(text, start, end) or HEX.match(text, start, end)
        if decided and not text[decided.end() : decided.end() + 1].isalnum():
            end = decided.end()
        else:
            own = OWN_NAME.match(text, start, end)
            if own and (closed or NO_STOP.search(text, own.end(), end)):
                continue
            if not closed:
                end = _without_stops(text, start, end)
                if own and own.end() <= end:
                    continue
        if end - start >= NAMED_LENGTH and not (end - start == len(MARK) and text.startswith(MARK, start)):
            yield start, end
            taken_to = end


def _outside(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a span that no span of ``taken``, in order and apart, covers."""
    at = max(0, bisect.bisect_right(taken, (start,)) - 1)
    while at < len(taken) and taken[at][0] < end:
        a, b = taken[at]
        at += 1
        if b > start:
            if a > start:
                yield start, a
            start = max(start, b)
    if start < end:
        yield start, end


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each candidate, in order and apart.

    Users and passwords of addresses come first, then named values, then runs; each has what those before it left. The time
    grows with the text's length, whatever it holds.
    """
    taken = sorted(set(_credentials(text)))
    more = [x for a, b in _named(text) for x in _outside(a, b, taken) if x[1] - x[0] >= NAMED_LENGTH]
    taken = sorted(taken + more)
    if not taken:
        yield from _runs(text)
        return
    runs = (x for a, b in _runs(text) for x in _outside(a, b, taken))
    yield from sorted([*taken, *((a, b) for a, b in runs if b - a >= LEAST_LENGTH and ANCHOR.search(text, a, b))])


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each run of token characters that is long enough and has an anchor, without its name."""
    at = 0
    while m := ANCHOR.search(text, at):
        start = m.start()
        while start > at and RUN.match(text[start - 1]):
            start -= 1
        end = RUN.match(text, start).end()
        a, b = _value(text[start:end])
        if b - a >= LEAST_LENGTH and ANCHOR.search(text, start + a, start + b):
            yield start + a, start + b
        at = max(end, m.end())


def known_label(text: str, start: int, end: int) -> int | None:
    """1 or 0 where the form of a finding decides by itself, else None."""
    value, before = text[start:end], text[max(0, start - 40) : start]
    if ACCESS_KEY.fullmatch(value):
        return 1
    if HEX.fullmatch(value) and re.search(rf"(?i){NEIGHBOUR.pattern}\w*\s*[=:]\s*[\"']?$", before):
        return 1
    if ASSIGNED.search(before) or (before.endswith("://") and text[end : end + 1] == "@"):
        return None  # a password may have any form
    if MAIL.fullmatch(value) or NUMBER.fullmatch(value) or ADDRESS.fullmatch(value) or WORD.fullmatch(value):
        return 0
    return None


class Language:
    """Transitions between characters and frequent words of the corpus."""

    def __init__(self, transitions: np.ndarray, words: set[str]):
        rows = transitions + 0.5
        self.logs = np.log(rows / rows.sum(axis=1, keepdims=True))
        self.words = words

    @staticmethod
    def codes(raw: bytes) -> np.ndarray:
        return np.minimum(np.frombuffer(raw, np.uint8), 128).astype(np.intp)

    def likelihood(self, value: str) -> float:
        c = self.codes(value.lower().encode())
        return float(self.logs[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0

    def covered(self, value: str) -> float:
        """The share of the value that words cover, the longest taken first from the left."""
        low, at, n = value.lower(), 0, 0
        while at < len(low):
            for size in range(min(12, len(low) - at), 2, -1):
                if low[at : at + size] in self.words:
                    n += size
                    at += size
                    break
            else:
                at += 1
        return n / len(low)


def features(text: str, start: int, end: int, language: Language) -> list[float]:
    value, n = text[start:end], end - start
    before, after = text[max(0, start - 40) : start], text[end : end + 2]
    near = max(0, start - 120)
    line = text[max(text.rfind("\n", near, start) + 1, near) : start]
    share = lambda ok: sum(map(ok, value)) / n
    words = re.findall(r"\w+", before)
    return [
        float(min(n, 200)),
        share(str.isdigit),
        share(str.isupper),
        share(str.islower),
        share(lambda c: not c.isalnum()),
        language.likelihood(value),
        len(set(value)) / min(n, 64),
        language.covered(value),
        float("/" in value or "." in value or before.endswith("/")),
        float("@" in value),
        float(bool(words and NEIGHBOUR.search(words[-1]))),
        float(bool(NEIGHBOUR.search(line))),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(before.endswith(('"', "'", "`")) and after[:1] in ('"', "'", "`")),
        2.0 if ASSIGNED.search(before) else float(bool(FOLLOWS.search(before))),
        float(before.endswith("://") and after[:1] == "@"),
    ]


def _language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, words = np.zeros((129, 129), np.int64), Counter()

    def seen() -> pa.RecordBatch:
        counted = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(words.values(), pa.int64())], ["item", "n"])
        words.clear()
        return counted

    for batch in batches:
        for text in batch.column("text"):
            raw = (text.as_py() or "").encode()
            for a in range(0, len(raw), 1 << 20):  # bounded arrays for very long texts
                c = Language.codes(raw[a : a + (1 << 20) + 1])
                counts += np.bincount(c[:-1] * 129 + c[1:], minlength=129 * 129).reshape(129, 129)
            words.update(w for w in raw.decode().lower().split() if DICTIONARY_WORD.fullmatch(w))
            if len(words) >= COUNTED:
                yield seen()
    yield seen()
    pairs = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array([f"\t{p}" for p in pairs], pa.string()), pa.array(counts.ravel()[pairs])], ["item", "n"])


def language(docs: DataFrame) -> Language:
    """Transitions and the most frequent words, counted over all documents (text).

    The driver gets a count for each pair of characters and the ``DICTIONARY`` most frequent words at most, each at
    least one in ``ONE_IN`` of all words: so many can stand for the whole language, whatever the corpus' size.
    """
    counts = docs.select("text").mapInArrow(_language, "item string, n long").groupBy("item").agg(F.sum("n").alias("n"))
    counts = stored(counts, "language")
    transitions = np.zeros(129 * 129)
    for r in counts.where(F.col("item").startswith("\t")).collect():
        transitions[int(r["item"])] = r["n"]
    words = counts.where(~F.col("item").startswith("\t"))
    least = words.agg(F.sum("n") / ONE_IN).scalar()
    top = words.where(F.col("n") >= least).orderBy(F.desc("n"), "item").limit(DICTIONARY).select("item").collect()
    return Language(transitions.reshape(129, 129), {r["item"] for r in top})


def _find(spoken: Language):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(*(batch.column(c) for c in ("doc_id", "text_hash", "text")), strict=True):
                text = text.as_py() or ""
                for a, b in candidates(text):
                    known = known_label(text, a, b)
                    kind = "access_key" if ACCESS_KEY.fullmatch(text, a, b) else "hex" if HEX.fullmatch(text, a, b) else "other"
                    rows.append((doc_id.as_py(), text_hash.as_py(), a, b - a, kind, known, features(text, a, b, spoken)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float64())]
            names = [f.split(" ")[0] for f in FINDING.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


#: Common words, parts of the given passwords, and what stands where a password would.
COMMON = """apple battle castle dragon engine forest guitar hammer island jungle kitchen ladder market needle orange planet
quiet river silver table under valley winter yellow bridge candle desert family garden horse""".split()
FILLERS = """required optional string password disabled enabled undefined unknown changed expired missing <password> ${PASSWORD}
******** xxxxxxxx YOUR_PASSWORD self.password get_token() os.environ null,true settings.secret %(password)s {{token}}""".split()


def given_findings(n: int = 400) -> list[tuple[str, int, int, int]]:
    """Labelled findings that come with the operator: text, start, end, label; made by a fixed generator."""
    rng = np.random.default_rng(SEED)
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    hexes, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    base = caps + caps[:26].lower() + "+/"
    out = []
    for i in range(n):
        k = int(rng.integers(16, 48))
        secret = (
            ("the key ", "AKIA" + pick(caps, 16), " was left"),
            ("password=", pick(hexes, k), " in it"),
            ('token = "', pick(hexes, 40), '" there'),
            ("secret: ", pick(base, k), "\n"),
            ("Authorization: Bearer ", pick(base, k), " sent"),
            ('api_key = "', pick(base, k), '"'),
        )[i % 6]
        plain = (
            ("write to ", f"{pick(hexes[10:], 6)}.{i}@mail{i % 9}.example.com", " soon"),
            ("see ", f"/usr/share/doc/part-{i}/notes.{i % 7}.html", " for it"),
            ("at https:", f"//www.example.org/page/{i * 37}/item-{i}", " today"),
            ("on ", f"2024-0{1 + i % 9}-11T0{i % 9}:30:00", " it began"),
            ("version ", f"release-{i % 9}.{i % 7}.12-final", " came"),
            ("call ", f"+49-30-{100000 + i * 31}-{i % 10}", " now"),
            ("and ", "".join(rng.choice(COMMON, 3)).upper(), str(rng.choice(["!", " ", ", "])) + "it"),
        )[i % 7]
        for (a, value, b), label in ((secret, 1), (plain, 0)):
            out.append((a + value + b, len(a), len(a) + len(value), label))
    return out


def given_passwords(n: int = 1200) -> list[tuple[str, int, int, int]]:
    """Labelled findings as ``given_findings``: named values and passwords in addresses, of any form."""
    rng = np.random.default_rng(SEED + 1)
    word = lambda: str(rng.choice(COMMON))
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    letters = "abcdefghijklmnopqrstuvwxyz"
    every = letters + letters.upper() + "0123456789" + "!@#$%&*-_+?"
    out = []
    for i in range(n):
        leet = word().translate(str.maketrans("aeos", "@30$")) if i % 2 else word()
        password = (
            str(rng.choice(["-", "_", "."])).join(word() for _ in range(rng.integers(3, 6))),
            leet.capitalize() + str(rng.choice(list("!&#@*$"))) + str(rng.integers(1, 9999)),
            pick(every, int(rng.integers(8, 20))),
            pick("bcdfghjklmnpqrstvwxz", int(rng.integers(8, 15))),
            word() + str(rng.integers(10, 9999)) + str(rng.choice(["", "!", "&x"])),
        )[i % 5]
        name = str(rng.choice("password passwd pwd secret token api_key auth_token DB_PASSWORD client_secret passphrase".split()))
        a, b = ((f"{name}=", " "), (f"{name}: ", "\n"), (f'{name} = "', '"'), (f"then {name}: ", ""), (f'"{name}": "', '",'))[i // 5 % 5]
        out.append((a + password + b, len(a), len(a) + len(password), 1))
        a = f"{rng.choice(['postgres', 'https', 'redis', 'amqp', 'mysql'])}://"
        info = f"{word()}:{password if i % 3 else word()}"
        out.append((f"{a}{info}@db{i % 7}.example.com/{word()}", len(a), len(a) + len(info), 1))
        a, value, b = (
            (f"the {rng.choice(['secret', 'private', 'key', 'access', 'password', 'token'])} ", word() + "ing", " of it"),
            (f"{name}: ", str(rng.choice(FILLERS)), "\n"),
            (f"{name} = ", str(rng.choice(FILLERS)), " then"),
            ("a key ", f"{word()}-{word()}-{word()}", " thing"),
            ("a private ", f"{word()},{word()}", " thing"),
            ("the access ", f"{2000 + i}-01-{10 + i % 19}T00:00:00", " log"),
            ("the key ", word().upper() + str(rng.choice(["!", "!!", "?", "...", ":"])), " was"),
        )[i % 7]
        out.append((a + value + b, len(a), len(a) + len(value), 0))
    return out


def findings(docs: DataFrame, spoken: Language) -> DataFrame:
    """Every candidate of ``docs`` (doc_id, text) with its features, and its label where its form decides."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_find(spoken), FINDING)


def fit(spark: SparkSession, found: DataFrame, spoken: Language, sample: int = SAMPLE) -> RandomForestClassificationModel:
    """A forest from the given findings and at most ``sample`` of each label of the corpus, drawn by hash."""
    given = [(float(y), features(t, a, b, spoken)) for t, a, b, y in [*given_findings(), *given_passwords()]]
    rows = spark.createDataFrame(given, "label double, features array<double>")
    for label in (0, 1):
        own = found.where(F.col("known") == label).orderBy(F.xxhash64("text_hash", "start"), "text_hash", "start").limit(sample)
        rows = rows.unionByName(own.select(F.col("known").cast("double").alias("label"), "features"))
    rows = rows.select("label", array_to_vector("features").alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows.coalesce(4))
    # A fitted forest holds its training summary, and with it the session, which tasks cannot be sent; a read one does not.
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    return RandomForestClassificationModel.load(path)


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row for each candidate of ``docs`` (doc_id, text): doc_id, text_hash, start, length, kind, score, is_secret.

    ``start`` and ``length`` count characters. The value itself is not returned. Null and empty texts have no
    candidate; a null or repeated doc_id is kept, and rows that are the same in both columns have findings
    each. Other columns are ignored.
    """
    spoken = language(docs)
    found = stored(findings(docs, spoken), "findings")
    forest = fit(docs.sparkSession, found, spoken, sample)
    scored = forest.transform(found.withColumn("features", array_to_vector("features")))
    score = vector_to_array("probability")[1]
    cells = scored.select("doc_id", "text_hash", "start", "length", "kind", F.round(score, 9).alias("score"))
    return cells.withColumn("is_secret", F.col("score") >= 0.5)


def _redacted(text: str | None, spans: list[dict] | None) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for start, length in sorted({(s["start"], s["length"]) for s in spans}):
        out += [text[at:start], MARK]
        at = start + length
    return "".join([*out, text[at:]])


def _redact(spans: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_redacted(t.as_py(), s.as_py()) for t, s in zip(batch.column("text"), batch.column(spans), strict=True)]
            names = [n for n in batch.schema.names if n != spans]
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with all columns, where each secret of ``found`` (from ``scan``) is replaced by ``MARK``.

    The spans of a text are joined by the text's hash and the doc_id, null-safe; few are broadcast, more are joined by
    shuffle. ``n_chars``, where present, follows the new text; a null text stays null.
    """
    own = "spans"
    while own in docs.columns:
        own += "_"
    spans = found.where("is_secret").groupBy(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash"))
    spans = stored(spans.agg(F.collect_set(F.struct("start", "length")).alias(own)), "spans")
    if spans.count() <= BROADCAST_FINDINGS:
        spans = F.broadcast(spans)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{own}id")) & (F.xxhash64("text") == F.col(f"{own}hash"))
    joined = docs.join(spans, same, "left").select(*docs.columns, own)
    clean = joined.mapInArrow(_redact(own), ", ".join(f"`{n}` {t}" for n, t in docs.dtypes))
    if "n_chars" in clean.columns:
        kind = dict(clean.dtypes)["n_chars"]
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return clean

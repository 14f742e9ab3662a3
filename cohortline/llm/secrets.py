"""Secret scan: candidates by pattern, false positives removed by a random forest.

Every run of 20 or more key characters is a candidate, and so is what stands
after a cue (an assignment to a key, token, password or secret, Bearer, user: in
front of @), six or more characters of any kind but space. A forest scores each by
length, character transitions (against transitions counted over all documents),
dictionary coverage, path and neighbouring words. It learns from labelled
findings: secrets and look-alikes of known formats in contexts from the documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.byte_pairs import Vocabulary, read_vocabulary
from cohortline.llm.inputs import batch, hashed_sample, steps, texts_of
from cohortline.settings import cut_lineage

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_CANDIDATE = re.compile(CANDIDATE)
#: A name, what assigns to it, and the words in names of what is kept secret, in the languages of the documents.
ASSIGNMENT = re.compile(r"(?<![\w.\]-])[\w.\]-]++[\"']?\]?\s{0,3}(?:=>|:=|==?|:)\s{0,3}")
NAME = re.compile(r"(?i)key|token|passw|passphrase|pass(?:e|code)?(?![a-z])|pwd|secret|credential|mdp|contrase[nñ]a|clave"
                  r"|kennwort|schl[uü](?:e|)ssel|geheim|jeton")
VALUE = re.compile(r"\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"']\S{5,})")
BEARER = re.compile(r"(?i)(?:\bbearer|authorization[\"']?\s{0,3}[:=]\s{0,3}[\"']?(?:basic|token))\s{1,3}([^\s\"']{6,})")
ADDRESS, USER, HOST = re.compile(r"\S+"), re.compile(r"(?<![\w.+%-])[\w.+%-]++:(?!//)"), re.compile("@(?=[A-Za-z0-9])")
#: What a text must contain for a cue to be looked for.
CUE_MARK = "(?i)key|token|pass|pwd|secret|credential|bearer|authorization|@|mdp|contrase|clave|kennwort|schl|geheim|jeton"
#: Most documents whose contexts carry labelled findings, and code points of a context.
CONTEXTS, CONTEXT = 1200, 300
TREES, DEPTH, SEED = 40, 8, 11
LEAST = 0.5
BEFORE, AFTER = 40, 12
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=- "
CODE = np.full(256, len(ALPHABET), np.uint16)
CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
SYMBOLS = len(ALPHABET) + 1

SPEAKS_FOR = re.compile(rf"(?i)bearer|auth|{NAME.pattern[4:]}")
SPEAKS_AGAINST = re.compile(r"(?i)(commit|sha\d*|md5|checksum|digest|hash|uuid|guid|etag|integrity|example|sample|func|def |class|path|url|http|www)")
EMBEDDED = re.compile(r"(?i)base64,\s?$|data:[\w/+.-]*$")
ASSIGNED = re.compile(r"[:=]\s*[\"']?$")
SIDE_PATH = re.compile(r"(?i)(?<![a-z])(tests?|testdata|examples?|samples?|mocks?|docs?|fixtures?|vendor)(?![a-z])")
NAMES = ["length", "digits", "capitals", "marks", "kinds", "different", "transitions", "coverage", "longest_letters",
         "hexadecimal", "prefix", "speaks_for", "speaks_against", "assigned", "quoted", "side_path", "after_mark",
         "refers", "in_address", "classes", "embedded"]
#: Calls, variables and places to fill, which name a secret and hold none.
REFERS = re.compile(r"[A-Za-z_]\w*[(\[]|^[<{]|^\$[{(A-Z_]|^%\w+%$|^[A-Za-z_]+(?:\.[A-Za-z_]+)+$|[*]{4}")
PREFIX = re.compile(r"^(AKIA|ASIA|ghp_|gho_|xox[abp]-|sk_live_|sk-|AIza|eyJ|glpat-)")


def transitions(docs: DataFrame) -> np.ndarray:
    """Log-probability of each symbol after each other one, counted over all texts."""
    schema = pa.schema([("pair", pa.int32()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for rows in batches:
            for _, _, data, offsets in steps(rows.column(0)):
                code = CODE[data].astype(np.int32)
                pairs = code[:-1] * SYMBOLS + code[1:]
                inside = np.ones(len(pairs), bool)
                edge = offsets[1:-1] - 1
                inside[edge[(edge >= 0) & (edge < len(pairs))]] = False
                total += np.bincount(pairs[inside], minlength=len(total))
        seen = np.flatnonzero(total)
        yield batch(schema.names, [seen.astype(np.int32), total[seen]], schema)
    found = texts_of(docs).select("text").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.ones(SYMBOLS * SYMBOLS)
    for r in found.collect():  # at most one row per pair of symbols
        table[r.pair] += r.n
    table = table.reshape(SYMBOLS, SYMBOLS)
    return np.log(table / table.sum(1, keepdims=True))


def dictionary(vocabulary: str) -> frozenset[str]:
    """Words of four and more letters among the tokens of a rank file."""
    tokens = (t.decode("utf-8", "replace").strip().lower() for t in Vocabulary(read_vocabulary(vocabulary)).tokens)
    return frozenset(t for t in tokens if len(t) >= 4 and t.isascii() and t.isalpha())


def _coverage(candidate: str, words: frozenset[str]) -> float:
    """Share of the candidate's characters inside dictionary words, longest first from the left."""
    covered = 0
    for run in re.findall(r"[a-z]+", candidate.lower()):
        i = 0
        while i < len(run):
            for size in range(min(12, len(run) - i), 3, -1):
                if run[i:i + size] in words:
                    covered += size
                    i += size
                    break
            else:
                i += 1
    return covered / len(candidate)


def features(candidate: str, before: str, after: str, path: str, table: np.ndarray, words: frozenset[str]) -> list[float]:
    code = CODE[np.frombuffer(candidate.encode(), np.uint8)]
    n = len(candidate)
    digits = sum(c.isdigit() for c in candidate)
    capitals = sum(c.isupper() for c in candidate)
    marks = sum(not c.isalnum() for c in candidate)
    letters = n - digits - marks
    return [float(x) for x in (
        min(n, 1000), digits / n, capitals / n, marks / n, (digits > 0) + (capitals > 0) + (letters > capitals),
        len(set(candidate)) / min(n, 64), table[code[:-1], code[1:]].mean(), _coverage(candidate, words),
        max((len(r) for r in re.findall("[A-Za-z]+", candidate)), default=0), bool(re.fullmatch("[0-9a-f]+", candidate)),
        bool(PREFIX.match(candidate)), bool(SPEAKS_FOR.search(before)), bool(SPEAKS_AGAINST.search(before)),
        bool(ASSIGNED.search(before)), before[-1:] in "\"'" and before[-1:] == after[:1] and before != "",
        bool(SIDE_PATH.search(path)), after[:1] in "\"';,)",
        bool(REFERS.search(candidate)), before[-1:] == ":" and after[:1] == "@",
        (digits > 0) + (capitals > 0) + (letters > capitals) + (marks > 0), bool(EMBEDDED.search(before)))]


_LETTERS = {"x": "0123456789abcdef", "b": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
            "a": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "n": "0123456789",
            "m": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
            "p": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz01234567890123456789.~!$&#%*?^"}
#: (label, words before, fixed start, letters, how many, words after)
FORMATS = [
    (1, 'token = "', "", "x", 40, '"'), (1, 'api_key: "', "", "x", 32, '"'), (1, "password=", "", "m", 24, " "),
    (1, "secret = '", "", "b", 40, "'"), (1, 'access_key = "', "AKIA", "a", 16, '"'), (1, "Authorization: Bearer ", "", "b", 64, "\n"),
    (1, "auth_token: ", "ghp_", "m", 36, "\n"), (1, 'key = "', "sk_live_", "m", 24, '"'), (1, "", "xoxb-", "m", 40, " "),
    (1, " ", "ghp_", "m", 36, " "), (1, 'private_key="', "", "b", 44, '"'),
    (0, "commit ", "", "x", 40, " "), (0, "sha256: ", "", "x", 64, "\n"), (0, "checksum ", "", "x", 32, " "),
    (0, 'hash = "', "", "x", 40, '"'), (0, "etag: ", "", "x", 32, "\n"), (0, "id ", "", "n", 24, " "), (0, " ", "", "n", 30, " "),
    (0, "integrity: ", "sha512-", "b", 64, "\n"), (0, "/", "", "x", 40, "/"), (0, " ", "", "x", 40, " "),
    (1, "password=", "", "p", 8, "\n"), (1, "password=", "", "p", 12, " "), (1, 'passwd: "', "", "p", 10, '"'),
    (1, "pwd=", "", "m", 8, " "), (1, "secret: ", "", "p", 16, "\n"), (1, "api_key = '", "", "x", 16, "'"),
    (1, "Authorization: Bearer ", "", "m", 16, "\n"), (1, "token=", "", "p", 18, " "), (1, 'key: "', "", "x", 16, '"'),
    (1, "postgres://admin:", "", "p", 10, "@db.internal/main"), (1, "https://user:", "", "m", 12, "@host.net/"),
    (0, "sort key: ", "", "n", 6, " "), (0, "token count: ", "", "n", 8, "\n"), (0, "key=", "", "n", 7, " "),
    (0, "keywords: ", "sha-", "x", 7, "\n"),
    (1, "mot de passe : ", "", "p", 10, "\n"), (1, "contraseña=", "", "p", 9, " "), (1, 'Passwort: "', "", "p", 11, '"'),
    (1, "DB_PASS=", "", "m", 8, "\n"), (1, "Kennwort: ", "", "p", 12, " "), (1, "clave: ", "", "m", 14, "\n"),
    (1, "jeton = '", "", "x", 32, "'"), (1, "MDP=", "", "p", 8, " "), (1, "geheimnis = ", "", "b", 24, "\n"),
    (0, "clave: ", "", "n", 6, " "), (0, "Schlüssel: ", "", "n", 7, "\n"),
    (0, "data:image/png;base64,", "iVBORw0KGgo", "b", 200, '"'), (0, "src=data:image/gif;base64,", "R0lGOD", "b", 120, "'"),
    (0, "url(data:font/woff2;base64,", "d09GMg", "b", 300, ")"), (0, "data:application/pdf;base64,", "", "b", 90, " "),
]
#: What names a secret and holds none, or only says so.
REFERENCES = [("password = ", "getpass.getpass()", "\n"), ("secret: ", "${CLIENT_SECRET}", "\n"), ("password=", "<your-password>", " "),
              ("token = ", "os.environ[\"TOKEN\"]", "\n"), ('password: "', "********", '"'), ("api_key=", "config.api_key", ")"),
              ("key = ", "lambda", " "), ("password: ", "required", "\n"), ("token: ", "string", "\n"), ("secret=", "$SECRET", " "),
              ("key=", "request.args.get('key')", "\n"), ("bearer ", "tokens", " "), ("password = '", "changeme", "'")]


#: Paths of planted findings besides the documents' own.
PATHS = ["src/app/settings.py", "deploy/config.yaml", "lib/client.js", "tests/test_client.py", "test/data/config.yaml",
         "examples/app.py", "docs/setup.md", "vendor/lib/client.js", "fixtures/keys.json", "mocks/server.js", "sample/run.py"]


def _placed(label: int, candidate: str, source: str, rng: np.random.Generator) -> tuple[int, str]:
    """The label of a planted finding at a drawn path: half have the document's own, the others one of ``PATHS``.

    A key of no provider's form is a look-alike under a test-like path.
    """
    path = source if rng.random() < 0.5 else PATHS[int(rng.integers(len(PATHS)))]
    return int(label and not (SIDE_PATH.search(path) and not PREFIX.match(candidate))), path


def _planted(row: int, words: list[str], rng: np.random.Generator):
    """(label, before, candidate, after) of the labelled findings that one document's words carry."""
    for label, before, start, letters, size, after in FORMATS:
        if rng.random() < 0.35:
            drawn = "".join(rng.choice(list(_LETTERS[letters]), size))
            yield label, " ".join(words[:6]) + " " + before, start + drawn, after
    if len(words) >= 6:  # long names, placeholders and rules of the document's own words
        name = "_".join(re.sub("[^A-Za-z]", "", w) for w in words[:6])[:60]
        if len(name) >= 20:
            yield 0, " ".join(words[6:10]) + " ", name, " "
            yield 0, 'token = "', "your_" + name + "_here", '"'
    plain = [w for w in (re.sub("[^A-Za-z]", "", w) for w in words) if len(w) >= 6][:4]
    for word in plain:  # a word is no secret after a cue; one with figures and marks put in is
        yield 0, str(rng.choice(["the key: ", "password: ", "token ", "bearer ", "secret: ",
                                   "mot de passe : ", "contraseña: ", "Passwort: ", "clave: "])), word.lower(), " "
        if rng.random() < 0.5:
            known = word[:9].title().translate(str.maketrans("oeia", "0314")) + str(rng.choice(list("&!$~?#"))) + str(rng.integers(1, 999))
            yield 1, str(rng.choice(["password=", "passwd: ", "secret = ", "pwd=", "token: ", "mot de passe : ",
                                       "contraseña: ", "Passwort: "])), known, str(rng.choice(["\n", " "]))
            yield 1, "ftp://" + word[:5].lower() + ":", known, "@files.net/"
        yield 0, "mailto:", word.lower() + "." + word[:4].lower(), "@mail.org "
    for before, reference, after in REFERENCES:
        if rng.random() < 0.2:
            yield 0, " ".join(words[:6]) + " " + before, reference, after
    yield 0, 'password = "', "x" * int(rng.integers(20, 40)), '"'
    yield 0, " ", "=" * int(rng.integers(20, 80)), "\n"
    yield 0, " ", "-" * int(rng.integers(20, 80)), "\n"


def labelled_findings(docs: DataFrame, table: np.ndarray, words: frozenset[str], path: str = "source") -> DataFrame:
    """(label, part, features) of planted findings in words, from a seeded place, of up to ``CONTEXTS`` documents."""
    schema = pa.schema([("label", pa.float64()), ("part", pa.int32()), ("values", pa.list_(pa.float64()))])
    shared = docs.sparkSession.sparkContext.broadcast((table, words))

    def plant(batches):
        known, dictionary_ = shared.value
        for rows in batches:
            out = [[], [], []]
            for doc_id, text, source in zip(*(c.to_pylist() for c in rows.columns)):
                rng = np.random.default_rng([SEED, (doc_id or 0) % (1 << 62)])
                for label, before, candidate, after in _planted(doc_id, text.split(), rng):
                    label, place = _placed(label, candidate, source, rng)
                    out[0].append(float(label))
                    out[1].append((doc_id or 0) % 4)
                    out[2].append(features(candidate, before[-BEFORE:], after[:AFTER], place, known, dictionary_))
            yield batch(schema.names, out, schema)
    own = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), own.alias("path"))
    beyond = F.greatest(F.length("text") - CONTEXT, F.lit(0)).cast("long")
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), beyond + 1).cast("int")
    some = hashed_sample(named.withColumn("text", F.substring("text", place + 1, F.lit(CONTEXT))),
                         ["doc_id", "text", "path"], CONTEXTS)
    return some.mapInArrow(plant, "label double, part int, values array<double>")


def _cued(text: str):
    """Matches of values after cues, each from the end of the one before, and of passwords in addresses."""
    at = 0
    while assigned := ASSIGNMENT.search(text, at):
        at = assigned.end()
        value = VALUE.match(text, at) if NAME.search(assigned[0]) else None
        if value:
            at = value.end()
            yield value.span(value.lastindex)
    for bearer in BEARER.finditer(text):
        yield bearer.span(1)
    for run in ADDRESS.finditer(text) if "@" in text else ():
        at = run.start()
        while user := USER.search(text, at, run.end()):
            host = HOST.search(text, min(user.end() + 6, run.end()), run.end())
            if not host:
                break
            yield user.end(), host.start()
            at = host.end()


def proposed(text: str) -> list[tuple[int, int]]:
    """(start, end) of every candidate of a text from left to right, each once; linear in the text."""
    spans = {m.span() for m in _CANDIDATE.finditer(text)}
    for start, end in _cued(text):
        size = len(text[start:end].rstrip(",;"))
        if size >= 6:
            spans.add((start, start + size))
    return sorted(spans)


def _found(shared, schema):
    def find(batches):
        known, words = shared.value
        for rows in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, text, path in zip(*(c.to_pylist() for c in rows.columns)):
                for start, end in proposed(text):
                    values = features(text[start:end], text[max(0, start - BEFORE):start], text[end:end + AFTER],
                                      path, known, words)
                    for column, item in zip(out, (doc_id, start, end, values)):
                        column.append(item)
            yield batch(schema.names, out, schema)
    return find


def secret_findings(docs: DataFrame, vocabulary: str, least: float = LEAST, key: str = "doc_id", text: str = "text",
                    path: str = "source") -> DataFrame:
    """(doc_id, start_at, end_at, score, secret) for every candidate of every row.

    Positions are code points, ends exclusive; candidates may overlap. ``secret`` tells whether the
    forest's score is at least ``least``; other candidates are false positives.
    NULL or empty texts give no row, a NULL path counts as empty; repeated rows
    give theirs each; a NULL doc_id stays NULL. Other columns are not read.
    """
    table, words = transitions(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))), dictionary(vocabulary)
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"))
    shared = docs.sparkSession.sparkContext.broadcast((table, words))
    schema = pa.schema([("doc_id", pa.int64()), ("start_at", pa.int64()), ("end_at", pa.int64()),
                        ("values", pa.list_(pa.float64()))])
    found = named.filter(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(CUE_MARK)).mapInArrow(
        _found(shared, schema), "doc_id long, start_at long, end_at long, values array<double>")
    forest = fit_forest(labelled_findings(named, table, words, "path"))
    if forest is None:
        return found.select("doc_id", "start_at", "end_at", F.lit(0.0).alias("score"), F.lit(False).alias("secret"))
    scored = forest.transform(found.withColumn("features", array_to_vector("values")))
    return scored.select("doc_id", "start_at", "end_at", vector_to_array("probability")[1].alias("score")) \
        .withColumn("secret", F.col("score") >= least)


def fit_forest(labelled: DataFrame):
    """A forest over labelled findings; None if there are none of one label."""
    rows = cut_lineage(labelled.withColumn("features", array_to_vector("values")).select("features", "label"))
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)

"""Secret scan with a random forest that removes false positives.

Candidates are found in whole texts with a few passes over their bytes: runs of the
characters that keys and tokens are made of (16 or more of them, or 8 with both
digits and letters), whatever follows a secret's name and = or :, however short,
the passwords of addresses, and blocks of private keys. Those that touch are one.
A random forest decides which are secrets by their length and composition, the
transitions between their characters, the share of their letters that dictionary
words cover, and by how much more often the words beside them, the words of their
file's path and their own beginning go with secrets than with others, which is learnt
from the findings. The dictionary is the most frequent words of all texts. The forest is trained by Spark from labelled findings; its nodes, a
table of a few thousand rows, are sent to the tasks, so that a text is scanned
and rated (or redacted) where it is read, without a shuffle.

labelled_findings() makes findings to train on where none are at hand: keys and
passwords of common kinds among the words that introduce them, and look-alikes
(digests, ids, numbers, names, runs of dictionary words) among theirs.

Defined results: a null or empty text has no candidates; a null path has no
words; copies of a row give equal findings; a candidate is rated by all its
characters, however many; time is linear in a text's length. scan() returns its own
columns alone; redact() changes the text and keeps all others, whatever their names.
Without dictionary words all letters count as uncovered.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterable, Iterator
from itertools import islice
from math import log, log2
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import small_batches
from .text import pieces, raw_bytes
from .vocabulary import frequent_words

#: Least characters of a candidate, and of one with both digits and letters.
LONG, SHORT = 16, 8
#: Bytes beside a candidate whose words count.
BESIDE = 48
#: Words in the dictionary.
DICTIONARY = 20_000
TREES, DEPTH, FINDINGS = 30, 10, 6000
#: Candidates rated together.
TOGETHER = 4096

#: Hashed words of a finding's surroundings, for each a weight.
SLOTS = 4096

#: Ends of names whose value is a candidate, however short.
NAMES = ("apikey", "auth", "authorization", "bearer", "credential", "credentials", "key", "login", "passphrase", "passwd", "password", "pwd", "secret", "secrets", "token", "tokens")

FEATURES = ["length", "digits", "upper", "lower", "other", "switches", "entropy", "surprise", "hex", "covered", "assigned", "quoted", "longest_letters", "address", "block", "different", "beside_sum", "beside_most", "beside_least", "last_word", "path", "beginning"]
_KEY = np.zeros(256, bool)
_KEY[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = True
_DIGIT, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58] = _LETTER[65:91] = _LETTER[97:123] = True
_WORDS = re.compile(r"[a-z0-9]+")
_LETTERS = re.compile(r"[A-Za-z]+")
#: A name before = or :, the value after it, a password in an address, and a block of a private key.
_NAME = re.compile(rb"([A-Za-z0-9_.-]+)[\"'`\])]*[ \t]{0,3}$")
_VALUE = re.compile(rb"[=:>]*[ \t]{0,3}[\"'`]?([^\s\"'`]+)")
_ADDRESS = re.compile(rb"://[^\s/:@]*:([^\s/@]+)@")
_BLOCK = re.compile(rb"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----([A-Za-z0-9+/=:,\s\\]+)")
#: Words inside names: db_password, dbPassword, API-KEY2.
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Dictionary:
    """Words, and how likely one letter follows another in them."""

    def __init__(self, words: list[str]):
        self.words = frozenset(w for w in words if 3 <= len(w) <= 12 and w.isascii() and w.isalpha())
        pairs: dict[str, int] = {}
        ones: dict[str, int] = {}
        for w in self.words:
            for a, b in zip(w, w[1:], strict=False):
                pairs[a + b] = pairs.get(a + b, 0) + 1
                ones[a] = ones.get(a, 0) + 1
        self.surprise = {a + b: -log((pairs.get(a + b, 0) + 0.5) / (ones.get(a, 0) + 13)) for a in string.ascii_lowercase for b in string.ascii_lowercase}

    def covered(self, letters: str) -> int:
        """Letters inside dictionary words, each time the longest from the left."""
        at = total = 0
        while at < len(letters):
            for n in range(min(12, len(letters) - at), 2, -1):
                if letters[at : at + n] in self.words:
                    total += n
                    at += n
                    break
            else:
                at += 1
        return total


def surroundings(before: str, candidate: str, after: str, path: str) -> tuple[list[int], int, list[int], int]:
    """The slots of the words beside a candidate, of the last one before it, of its path's words and of its beginning."""
    slot = lambda kind, word: crc32(f"{kind}:{word}".encode()) % SLOTS
    ahead = [w.lower() for w in _PARTS.findall(before)[-4:]]
    beside = ahead + [w.lower() for w in _PARTS.findall(after[:24])[:2]]
    return [slot("beside", w) for w in beside], slot("last", ahead[-1] if ahead else ""), [slot("path", w.lower()) for w in _PARTS.findall(path)], slot("begins", candidate[:4])


def slot_counts(findings: Iterable[tuple[str, str, str, str, float]]) -> np.ndarray:
    """How many findings of each label, others first, have each slot, and in the last row how many there are."""
    counts = np.zeros((SLOTS + 1, 2))
    for before, candidate, after, path, label in findings:
        beside, last, place, begins = surroundings(before, candidate, after, path)
        counts[list({*beside, last, *place, begins}), int(label > 0.5)] += 1
        counts[SLOTS, int(label > 0.5)] += 1
    return counts


def slot_weights(counts: np.ndarray) -> np.ndarray:
    """For each slot the logarithm of how much more often it goes with secrets; 0 for one that was never seen."""
    share = (counts[:SLOTS] + 1) / (counts[SLOTS] + 2)
    seen = counts[:SLOTS].sum(axis=1) > 0
    return np.where(seen, np.log(share[:, 1] / share[:, 0]), 0.0)


def features(before: str, candidate: str, after: str, path: str, dictionary: Dictionary, weights: np.ndarray) -> list[float]:
    n = len(candidate)
    digits, upper, lower = (sum(map(f, candidate)) for f in (str.isdigit, str.isupper, str.islower))
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in candidate]
    counts: dict[str, int] = {}
    for c in candidate:
        counts[c] = counts.get(c, 0) + 1
    runs = [x.lower() for x in _LETTERS.findall(candidate)]
    pairs = [dictionary.surprise[r[i : i + 2]] for r in runs for i in range(len(r) - 1)]
    letters = sum(map(len, runs))
    lead = before.rstrip().rstrip("\"'`").rstrip()
    beside, last, place, begins = surroundings(before, candidate, after, path)
    near = [float(weights[x]) for x in beside] or [0.0]
    return [
        float(min(n, 200)),
        digits / n,
        upper / n,
        lower / n,
        1 - (digits + upper + lower) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        -sum(v / n * log2(v / n) for v in counts.values()),
        sum(pairs) / len(pairs) if pairs else 6.0,
        float(all(c in "0123456789abcdefABCDEF" for c in candidate)),
        sum(map(dictionary.covered, runs)) / letters if letters else 0.0,
        float(lead.endswith(("=", ":"))) + 0.5 * float(lead.endswith((">", "is"))),
        float(before.endswith(('"', "'", "`"))),
        float(max(map(len, runs), default=0)) / n,
        float(after.startswith("@") and "://" in before),
        float(before.endswith("KEY-----")),
        len(counts) / n,
        sum(near),
        max(near),
        min(near),
        float(weights[last]),
        sum((float(weights[x]) for x in place), 0.0),
        float(weights[begins]),
    ]


def named(word: str) -> bool:
    """Whether a name is that of a secret: password, db_password, dbPassword, API-KEY."""
    return word.lower().endswith(NAMES)


def labelled_findings(words: list[str], n: int = FINDINGS, seed: int = 5) -> list[tuple[str, str, str, str, float]]:
    """n findings (before, candidate, after, path, label), half of them secrets."""
    rng = random.Random(seed)
    usual = [w for w in words if 3 <= len(w) <= 12 and w.isascii() and w.isalpha()] or ["the", "and", "word", "other", "value"]
    text = lambda k: " ".join(rng.choice(usual) for _ in range(k))
    pick = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    hexes, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    found = []
    for i in range(n):
        end = rng.choice([f" {text(2)}", f", {text(2)}", ".", f"\n{text(2)}", ""])
        if i % 2:
            kind = rng.randrange(9)
            if kind == 0:
                candidate, before = "AKIA" + pick(string.ascii_uppercase + string.digits, 16), rng.choice([f"{text(3)} ", "aws_access_key_id = ", "AWS key: "])
            elif kind == 1:
                candidate = pick(hexes, rng.choice([32, 40, 40, 64]))
                before = f"{text(3)} {rng.choice(['token', 'api_key', 'secret', 'auth token', 'access key'])}{rng.choice([' = ', '=', ': '])}{rng.choice(['', chr(34), chr(39)])}"
            elif kind == 2:
                candidate = pick(rng.choice([hexes, mixed, string.ascii_lowercase + string.digits]), rng.randint(10, 24))
                before = f"{text(3)} {rng.choice(['password', 'passwd', 'pwd', 'PASSWORD', 'login password'])}{rng.choice(['=', ': ', ' = '])}{rng.choice(['', chr(34)])}"
            elif kind == 3:
                candidate = rng.choice(["ghp_", "glpat-", "xoxb-", "sk-", "sk_live_", "AIza"]) + pick(mixed, rng.randint(20, 40))
                before = rng.choice([f"{text(3)} ", "Authorization: Bearer ", f"{text(2)} token: "])
            elif kind == 4:
                candidate = pick(mixed + "+/", rng.randint(24, 64))
                before = f"{text(3)} {rng.choice(['secret', 'secret_key', 'private key', 'client_secret', 'token', 'credentials'])}{rng.choice([' = ', '=', ': '])}{rng.choice(['', chr(34)])}"
            elif kind == 5:
                candidate = pick(mixed + "_-", rng.randint(32, 48))
                before = f"{text(3)} {rng.choice(['bearer', 'auth', 'key', 'apikey'])}{rng.choice([' ', '=', ': '])}"
            elif kind == 6:
                word = rng.choice([pick(string.ascii_lowercase, rng.randint(6, 12)), (rng.choice(usual) + rng.choice(usual))[:14], rng.choice(usual).title() + str(rng.randint(1, 9999)), pick(mixed, rng.randint(5, 9))])
                candidate = rng.choice([word, word + rng.choice("!$#%&?*") + str(rng.randint(0, 99)), word.replace("e", "3").replace("o", "0") + rng.choice("!@#$%^&")])
                before = f"{text(3)} {rng.choice(['password', 'passwd', 'pwd', 'db_password', 'login', 'passphrase', 'secret'])}{rng.choice(['=', ': ', ' = ', ':'])}{rng.choice(['', chr(34), chr(39)])}"
            elif kind == 7:
                candidate = pick(rng.choice([mixed, string.ascii_lowercase + string.digits, mixed + "!$%*-_"]), rng.randint(5, 20))
                before, end = f"{text(2)} {rng.choice(['postgres', 'https', 'mysql', 'amqp', 'redis', 'ftp'])}://{rng.choice(usual)}:", f"@{rng.choice(usual)}.{rng.choice(['com', 'local:5432', 'org/db'])}"
            else:
                candidate = "\n" + "\n".join(pick(mixed + "+/", 64) for _ in range(rng.randint(2, 12))) + "\n"
                before, end = f"{text(1)} -----BEGIN {rng.choice(['', 'RSA ', 'EC ', 'OPENSSH '])}PRIVATE KEY-----", "-----END"
            path = rng.choice(["", "src0", "app/config/settings", ".env", "deploy/prod", "src/main"])
        else:
            kind = rng.randrange(13)
            before = f"{text(4)} "
            if kind == 0:
                candidate = "".join(rng.choice(usual) for _ in range(8))[: rng.randint(16, 34)]
            elif kind == 1:
                candidate = "".join(rng.choice(usual) for _ in range(8))[: rng.randint(16, 30)]
                candidate = rng.choice([candidate.upper(), candidate.title()])
            elif kind == 2:
                candidate, before = pick(hexes, rng.choice([32, 40, 64])), f"{text(2)} {rng.choice(['sha1', 'sha256', 'md5', 'commit', 'checksum', 'digest', 'etag', 'hash', 'revision'])}{rng.choice([' ', ': ', '=', ' = '])}"
            elif kind == 3:
                candidate, before = "-".join(pick(hexes, k) for k in (8, 4, 4, 4, 12)), f"{text(2)} {rng.choice(['uuid', 'id', 'guid', 'order', ''])} "
            elif kind == 4:
                candidate, before = pick(string.digits, rng.randint(16, 20)), f"{text(3)} {rng.choice(['', '', 'card', 'account', 'number', 'invoice'])} "
            elif kind == 5:
                candidate = rng.choice(["_", "-", "/", ""]).join(rng.choice(usual) if rng.random() < 0.8 else str(rng.randint(1, 99)) for _ in range(rng.randint(3, 5)))
                candidate = candidate if len(candidate) >= SHORT else candidate + "identifier1"
            elif kind == 6:
                candidate = rng.choice(["-", "=", "_", "x", "0", "/"]) * rng.randint(16, 40)
            elif kind == 7:
                candidate = f"{rng.choice(usual)}{rng.randint(1, 9999)}"
                candidate = candidate if len(candidate) >= SHORT else candidate + "section7"
            elif kind == 8:
                candidate, before = "/".join(rng.choice(usual) for _ in range(4)) + f"/{rng.randint(1, 99)}", rng.choice([f"{text(2)} ", "href=", f"{text(2)} page: "])
            elif kind in (9, 10):  # said of a secret, not the secret
                candidate, before = rng.choice(usual), f"{text(3)} {rng.choice(['password', 'token', 'key', 'secret', 'auth', 'login', 'credentials', 'passphrase'])}{rng.choice([': ', ': ', '=', ' = '])}{rng.choice(['', '', chr(34)])}"
            elif kind == 11:
                candidate = rng.choice(["<password>", "<token>", "${DB_PASSWORD}", "$TOKEN", "{{secret}}", "********", "xxxxxxxx", "None", "null", "true", "false", "...", "[REDACTED]", "%s", "your_password_here", "os.environ", "-", "(optional)"])
                before = f"{text(3)} {rng.choice(['password', 'token', 'api_key', 'secret', 'pwd'])}{rng.choice(['=', ': ', ' = '])}{rng.choice(['', chr(34)])}"
            else:
                candidate, before = f"https://{rng.choice(usual)}.org/{rng.choice(usual)}", f"{text(2)} {rng.choice(['key', 'token', 'login', 'auth'])}: "
            path = rng.choice(["", "src0", "tests/fixtures", "docs/example", "src/main", "package-lock"])
        found.append((before[-BESIDE:], candidate, end, path, float(i % 2)))
    return found


def fit_forest(spark: SparkSession, findings: list[tuple[str, str, str, str, float]] | DataFrame, dictionary: Dictionary, seed: int = 7) -> tuple[Forest, np.ndarray]:
    """(a forest, weights of slots) learnt from labelled findings.

    Findings are (before, candidate, after, path, label), a list or a table. A finding's
    own label must not speak through its words, so findings are halved, and each half is
    described by the weights of the other; every fourth is described as if its
    surroundings had never been seen, so that the forest can do without them.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    columns = ["before", "candidate", "after", "path", "label"]
    counts, columns = np.zeros((2, SLOTS + 1, 2)), ["before", "candidate", "after", "path", "label"]
    if isinstance(findings, DataFrame):
        turn = F.crc32(F.concat("before", "candidate", "after"))
        found = findings.select(*columns).withColumn("half", (turn % 2).cast("int")).withColumn("which", F.when(F.floor(turn / 2) % 4 == 0, 2).otherwise((turn % 2).cast("int")))

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for half, own in batch.groupby("half"):
                    held = slot_counts(own[columns].itertuples(index=False, name=None))
                    slot, label = np.nonzero(held)
                    yield pd.DataFrame({"half": half, "slot": slot, "label": label, "n": held[slot, label]})

        # at most SLOTS rows for each half and label
        for r in found.mapInPandas(count, "half int, slot bigint, label bigint, n double").groupBy("half", "slot", "label").agg(F.sum("n").alias("n")).collect():
            counts[r.half, r.slot, r.label] = r.n
        each = [slot_weights(counts[1]), slot_weights(counts[0]), np.zeros(SLOTS)]

        @F.pandas_udf("array<double>")
        def described(before: pd.Series, candidate: pd.Series, after: pd.Series, path: pd.Series, which: pd.Series) -> pd.Series:
            return pd.Series([features(*row, dictionary, each[w]) for *row, w in zip(before, candidate, after, path, which, strict=True)])

        rows = found.select(described(*columns[:4], "which").alias("x"), F.col("label").cast("double").alias("label"))
    else:
        turns = [crc32((b + c + a).encode()) for b, c, a, _, _ in findings]
        for half in (0, 1):
            counts[half] = slot_counts(f for f, t in zip(findings, turns, strict=True) if t % 2 == half)
        each = [slot_weights(counts[1]), slot_weights(counts[0]), np.zeros(SLOTS)]
        made = [(features(*f[:4], dictionary, each[2 if t // 2 % 4 == 0 else t % 2]), f[4]) for f, t in zip(findings, turns, strict=True)]
        rows = spark.createDataFrame(made, "x array<double>, label double")
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(rows.select(array_to_vector("x").alias("features"), "label"))
    if not all(hasattr(tree, "_java_obj") for tree in model.trees):
        raise TypeError("this session's forests have no nodes that can be read")
    return Forest([_nodes(tree._java_obj.rootNode()) for tree in model.trees]), slot_weights(counts.sum(axis=0))


class Forest:
    """Trees as arrays (tree, node), so that all findings go down all trees together."""

    def __init__(self, trees: list[list[tuple]]):
        most = max(map(len, trees))
        padded = np.array([[*tree, *[(-1, 0.0, 0, 0, 0.0)] * (most - len(tree))] for tree in trees], np.float64)
        self.feature, self.left, self.right = (padded[..., i].astype(np.int32) for i in (0, 2, 3))
        self.threshold, self.share = padded[..., 1], padded[..., 4]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.feature, self.left, self.right, self.threshold, self.share

    @classmethod
    def of(cls, arrays: tuple[np.ndarray, ...]) -> Forest:
        """From arrays(), which executors can read without this module."""
        forest = cls.__new__(cls)
        forest.feature, forest.left, forest.right, forest.threshold, forest.share = arrays
        return forest

    def __len__(self) -> int:
        return len(self.feature)

    def rate(self, x: np.ndarray) -> np.ndarray:
        """The mean share of secrets in the leaves of each row."""
        tree, row = np.arange(len(self))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self)), np.int32)
        while True:
            feature = self.feature[tree, node]
            if (feature < 0).all():
                return self.share[tree, node].mean(axis=1)
            below = x[row, np.maximum(feature, 0)] <= self.threshold[tree, node]
            node = np.where(feature < 0, node, np.where(below, self.left[tree, node], self.right[tree, node]))


def _nodes(root) -> list[tuple]:
    """A tree's nodes: (feature or -1, threshold, left, right, share of secrets in a leaf)."""
    out: list[tuple] = []

    def add(node) -> int:
        at = len(out)
        out.append(())
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            out[at] = (-1, 0.0, 0, 0, stats[1] / max(sum(stats), 1e-12))
        else:
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            out[at] = (split.featureIndex(), split.threshold(), left, right, 0.0)
        return at

    add(root)
    return out


def _key_runs(data: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """Runs of key characters that are long, or have both digits and letters."""
    inside = _KEY[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = at[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    start[edge], end[edge - 1] = inside[edge], inside[edge - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    able = ends - starts >= SHORT
    starts, ends = starts[able], ends[able]
    both = np.ones(len(starts), bool)
    for kind in (_DIGIT, _LETTER):
        upto = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int32)])
        both &= upto[ends] > upto[starts]
    able = both | (ends - starts >= LONG)
    return list(zip(starts[able].tolist(), ends[able].tolist(), strict=True))


def _named_values(whole: bytes, data: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """What follows the name of a secret and = or :, up to white space or a quote."""
    found, upto = [], 0
    for x in np.flatnonzero((data == 61) | (data == 58)).tolist():
        if x < upto:
            continue
        text = int(np.searchsorted(at, x, side="right")) - 1
        name = _NAME.search(whole[max(int(at[text]), x - BESIDE) : x])
        if name and named(name[1].decode()):
            value = _VALUE.match(whole, x + 1, int(at[text + 1]))
            if value:
                y = value.start(1) + len(value[1].rstrip(b".,;)]}>"))
                if y > value.start(1):
                    found.append((value.start(1), y))
                    upto = y
    return found


def _matches(pattern: re.Pattern, mark: bytes, whole: bytes, at: np.ndarray) -> list[tuple[int, int]]:
    """What the pattern's group takes wherever the pattern begins with the mark, inside one text."""
    found, x = [], whole.find(mark)
    while x >= 0:
        m = pattern.match(whole, x, int(at[np.searchsorted(at, x, side="right")]))
        if m:
            found.append(m.span(1))
        x = whole.find(mark, m.end() if m else x + len(mark))
    return found


def candidates(texts: pa.Array) -> Iterator[tuple[int, int, str, str, str]]:
    """(text, first character, before, candidate, after) of each candidate, in order."""
    for a, b in pieces(texts):
        data, at = raw_bytes(texts.slice(a, b - a))
        whole = data.tobytes()
        spans = _key_runs(data, at) + _named_values(whole, data, at) + _matches(_ADDRESS, b"://", whole, at) + _matches(_BLOCK, b"-----BEGIN ", whole, at)
        merged: list[tuple[int, int]] = []
        for x, y in sorted(spans):
            if merged and x < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], y))
            else:
                merged.append((x, y))
        text, last, chars = -1, 0, 0
        for x, y in merged:
            own = int(np.searchsorted(at, x, side="right")) - 1
            low, high = int(at[own]), int(at[own + 1])
            if own != text:
                text, last, chars = own, low, 0
            chars += int(np.count_nonzero((data[last:x] & 0xC0) != 0x80))  # bytes that begin a character
            last = x
            beside = (whole[max(low, x - BESIDE) : x], whole[x:y], whole[y : min(high, y + BESIDE)])
            yield (a + own, chars, *(part.decode("utf-8", "ignore") for part in beside))


def _rated(texts: pa.Array, paths: list[str | None], forest: Forest, dictionary: Dictionary, weights: np.ndarray) -> Iterator[tuple[int, int, str, float]]:
    """(text, first character, candidate, score) of each candidate."""
    found = candidates(texts)
    while some := list(islice(found, TOGETHER)):
        x = np.array([features(before, candidate, after, paths[i] or "", dictionary, weights) for i, _, before, candidate, after in some])
        yield from ((i, at, candidate, score) for (i, at, _, candidate, _), score in zip(some, forest.rate(x).tolist(), strict=True))


class Scanner:
    """A forest and its dictionary, trained once, for scanning or redacting tables of texts."""

    def __init__(self, spark: SparkSession, words: list[str], findings: list | DataFrame | None = None, threshold: float = 0.5):
        forest, weights = fit_forest(spark, findings if findings is not None else labelled_findings(words), Dictionary(words))
        self.threshold, self._spark = threshold, spark
        self._shared = spark.sparkContext.broadcast((forest.arrays(), words, weights))

    def scan(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
        """(doc_id, start, n_chars, candidate, score, secret): a row for each candidate, by its first character from 0."""
        shared, threshold = self._shared, self.threshold
        small_batches(docs.sparkSession)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrays, words, weights = shared.value
            forest = Forest.of(arrays)
            dictionary = Dictionary(words)
            for batch in batches:
                ids = batch.column(0)
                rows = list(_rated(batch.column(1), batch.column(2).to_pylist(), forest, dictionary, weights))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([r[0] for r in rows], pa.int32())),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([len(r[2]) for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.string()),
                        pa.array([r[3] for r in rows], pa.float64()),
                        pa.array([r[3] >= threshold for r in rows], pa.bool_()),
                    ],
                    names=["doc_id", "start", "n_chars", "candidate", "score", "secret"],
                )

        rows = docs.select(F.col(doc_id).cast("bigint"), F.col(text), F.col(path).cast("string"))
        return rows.mapInArrow(find, "doc_id bigint, start bigint, n_chars bigint, candidate string, score double, secret boolean")

    def quality(self, findings: list[tuple[str, str, str, str, float]]) -> tuple[float, float]:
        """(precision, recall) over labelled findings that the forest was not trained on."""
        arrays, words, weights = self._shared.value
        forest = Forest.of(arrays)
        dictionary = Dictionary(words)
        said = forest.rate(np.array([features(b, c, a, p, dictionary, weights) for b, c, a, p, _ in findings])) >= self.threshold
        truth = np.array([y > 0.5 for *_, y in findings])
        both = float((said & truth).sum())
        return both / max(float(said.sum()), 1.0), both / max(float(truth.sum()), 1.0)

    def redact(self, docs: DataFrame, text: str = "text", path: str = "source", mark: str = "[REDACTED]") -> DataFrame:
        """docs with every secret in the text replaced by mark."""
        shared, threshold = self._shared, self.threshold
        small_batches(docs.sparkSession)

        @F.pandas_udf("string")
        def clean(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            arrays, words, weights = shared.value
            forest = Forest.of(arrays)
            dictionary = Dictionary(words)
            for texts, paths in batches:
                out = texts.astype(object).tolist()
                found: dict[int, list[tuple[int, int]]] = {}
                for i, at, candidate, score in _rated(pa.array(out, pa.string(), from_pandas=True), paths.tolist(), forest, dictionary, weights):
                    if score >= threshold:
                        found.setdefault(i, []).append((at, at + len(candidate)))
                for i, spans in found.items():
                    parts, last = [], 0
                    for a, b in spans:
                        parts += [out[i][last:a], mark]
                        last = b
                    out[i] = "".join([*parts, out[i][last:]])
                yield pd.Series(out, dtype=object)

        return docs.withColumn(text, clean(F.col(text), F.coalesce(F.col(path).cast("string"), F.lit(""))))


def dictionary_words(docs: DataFrame, text: str = "text", most: int = DICTIONARY) -> list[str]:
    """The words of 3 to 12 ASCII letters that all texts use most, more than once."""
    return frequent_words(docs.select(F.col(text).alias("text")), most, "n > 1 and word rlike '^[a-z]{3,12}$'")



"""Pages of repeated keywords, links or tags: bagged trees on weak labels, smoothed by host."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.columns import let

from sparkseg.llm.forest import Forest
from sparkseg.llm.language import SEEDS
from sparkseg.llm.sampling import drawn
from sparkseg.operators.skew import salted_left_join
from sparkseg.session import checkpointed

#: Documents of the sample on which the trees are grown and the hosts' weight is fitted: those of the least hashes of the key.
SAMPLE = 6000
#: Share of the sample that grows no trees, on which the hosts' weight is fitted.
HELD_OUT = 0.25
#: Pages of average rate added to each host; weights of the hosts that are tried.
HOST_SMOOTHING = 20.0
HOST_WEIGHTS = tuple(k / 10 for k in range(16))
SPAM = 0.5
TREES, DEPTH = 40, 8
#: Bytes of the windows that are compressed.
WINDOW = 400
BATCH = 512

FEATURES = ("length", "links", "link_items", "sentences", "tags", "repeats", "top_pair", "marks", "digits", "capitals", "item_words", "local_words", "stuffed")

_STOP = re.compile(r"[.!?।؟。！？][\"')»”」]?(?=\s|$|[^\x00-\xff])")
_LAST = frozenset(".!?।؟。！？\"')]»”」♪}）】>*")
_URL = re.compile(r"\S*(?:https?://|www\.)\S*")
_LEAD = re.compile(r"^\s*(?:[\[(<]?\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d+)?[\])>]?\s*)?(?:[^\s:]{1,20}(?: [^\s:]{1,20}){0,2}:\s+)?")
_DENSE = re.compile(r"[぀-ヿ㐀-鿿]+")
_MARKS = re.compile(r"[,|>;、•#，،]")
#: Least coverage of a text by its most frequent pair that counts.
PAIR_SHARE = 0.16


def features(text: str) -> list[float]:
    """The ``FEATURES`` of a text, each over the whole of it.

    Shares are of the text without time marks and labels. A text is taken as items: lines, and sentences within them, without a leading time mark and
    speaker label. Words are what white space and list marks part; in Chinese and Japanese,
    single characters, and runs of four where others count pairs.
    """
    size = max(1, len(text))
    dense = not text.isascii() and 3 * sum(map(len, _DENSE.findall(text))) > size
    links = link_items = sentences = tags = repeats = stuffed = marks = capitals = items = body = 0
    words: list[str] = []
    for line in text.splitlines():
        if not line or line.isspace():
            continue
        listed = False
        if "www." in line or "://" in line:
            span = sum(map(len, _URL.findall(line)))
            links += span
            rest = _URL.sub(" ", line)
            listed = len(line) - span < max(40, span)
            if listed:
                link_items += len(line)
            line = rest
        if ":" in line:
            line = _LEAD.sub("", line, 1)
        marked = _MARKS.search(line) is not None
        upper = line.isupper()
        line = line.lower()
        if not (marked or upper or dense):
            # most lines: nothing repeated, so nothing to look for sentence by sentence
            low = line.split()
            if len(low) - len(set(low)) < 2:
                items += 1
                words += low
                body += len(line)
                if not listed:
                    sentences += len(line) if line.rstrip()[-1:] in _LAST else len(line) - len(_STOP.split(line)[-1])
                continue
        pieces = _STOP.split(line)
        last = len(pieces) - 1
        for i, piece in enumerate(pieces):
            if not piece or piece.isspace():
                continue
            items += 1
            weight = len(piece)
            body += weight
            separators = hashes = 0
            if marked:
                hashes = piece.count("#")
                piece, separators = _MARKS.subn(" ", piece)
                marks += separators
            low = [c for w in piece.split() for c in w] if dense else piece.split()
            n = len(low)
            words += low
            if upper and n > 2:
                capitals += weight
            if hashes and (hashes * 3 >= n or dense and hashes > 1):
                tags += weight
            if n - len(set(low)) >= 2:
                grams = [*zip(low, low[1:], low[2:], low[3:])] if dense else [g for g in zip(low, low[1:]) if g[0] != g[1]]
                again = len(grams) - len(set(grams))
                if again:
                    repeats += weight * min(1.0, 2 * again / len(grams))
                    if again >= 2 and again * (4 if dense else 5) >= len(grams):
                        stuffed += weight
                        continue
            if (i < last or piece.rstrip()[-1:] in _LAST) and not listed and hashes < 2 and separators * 3 <= n:
                sentences += weight
    n = len(words)
    top, local = 0.0, 1.0
    if n > 3:
        # a pair that covers enough has a first word that is frequent enough by itself
        span = 4 if dense else 2
        if max(Counter(words).values()) * span >= PAIR_SHARE * n:
            grams = Counter(zip(words, words[1:], words[2:], words[3:]) if dense else zip(words, words[1:]))
            common = next((k for g, k in grams.most_common(3) if g[0] != g[1]), 0) * span / n
            top = common if common >= PAIR_SHARE else 0.0
        step = 60 if dense else 30
        parts = [len(set(words[i : i + step])) for i in range(0, n - n % step, step)]
        local = sum(parts) / (step * len(parts)) if parts else len(set(words)) / n
    digits = sum(map(text.count, "0123456789"))
    n, body = max(1, n), max(1, body + links)
    return [math.log1p(size), links / size, link_items / size, sentences / body, tags / body, repeats / body, top, marks / n, digits / size, capitals / body, n / max(1, items), local, stuffed / body]


SIGNALS = ("squeezed", "closed", "listed", "pressed")
# fixed values: marks that end a sentence, and what may stand behind them
_ENDS, _BEHIND = tuple(".!?।؟。！？♪…"), " \u200b\"'»”)】）*♪]>"

_CLAUSE = re.compile(r"[.!?।؟。！？\n]+")
_LONG_WORD = re.compile(r"[^\W\d_]{4,}|[가-힣]{2,}|[぀-ヿ㐀-鿿]{3,}")


def _pressed(text: str) -> float:
    """Share of the sentences that have the text's most frequent long word (three characters in Chinese and Japanese) twice."""
    said = []
    for clause in _CLAUSE.split(text.lower()):
        found = _LONG_WORD.findall(clause)
        if found:
            said.append([w[i : i + 3] for w in found for i in range(len(w) - 2)] if _DENSE.match(found[0]) else found)
    if not said:
        return 0.0
    most = Counter(w for words in said for w in words).most_common(1)
    return sum(1 for words in said if most and words.count(most[0][0]) > 1) / len(said)


def signals(text: str) -> list[float]:
    """The ``SIGNALS`` of a text, which the trees don't see: what it is squeezed to, and what its lines end and begin with.

    ``squeezed`` is the mean ratio to which windows of ``WINDOW`` bytes of the text in small letters are
    compressed; ``closed`` the share of the text on lines that end, links aside, in a sentence mark;
    ``listed`` the share of lines that hold a link or begin with #; ``pressed`` the share of sentences that say
    the text's most frequent word twice.
    """
    plain = " ".join(text.split()).lower().encode("utf-8", "surrogatepass")
    whole = max(WINDOW, len(plain) - len(plain) % WINDOW)
    parts = [plain[i : i + WINDOW] for i in range(0, whole, WINDOW)]
    lines = [x for x in text.splitlines() if x and not x.isspace()]
    size = max(1, sum(map(len, lines)))
    closed = sum(len(x) for x in lines if (_URL.sub(" ", x) if "www." in x or "://" in x else x).rstrip(_BEHIND).endswith(_ENDS))
    listed = sum(1 for x in lines if "www." in x or "://" in x or x.lstrip().startswith("#"))
    squeezed = sum(len(zlib.compress(p, 6)) / max(1, len(p)) for p in parts) / len(parts)
    return [squeezed, closed / size, listed / max(1, len(lines)), _pressed(text)]


def weak_labels(s: np.ndarray) -> np.ndarray:
    """1 for what the signals show to be spam, 0 for prose, -1 where they don't tell."""
    squeezed, closed, listed, pressed = (s[:, i] for i in range(len(SIGNALS)))
    spam = (closed < 0.3) & ((listed > 0.6) | (squeezed < 0.48)) | (closed < 0.6) & (squeezed < 0.4) | (squeezed < 0.45) & (pressed > 0.3)
    prose = (closed >= 0.6) & ((squeezed > 0.5) | (squeezed > 0.3) & (pressed < 0.1)) | (squeezed > 0.72) & (listed == 0)
    return np.where(spam, 1, np.where(prose, 0, -1))


def seed_pages() -> list[tuple[str, int]]:
    """Pages of both kinds in each language, made by rule, so that the trees have both to grow on in any table."""
    out = []
    for code, text in SEEDS.items():
        rng = random.Random(code)
        words = text.split() if code not in ("ja", "zh") else [text[i : i + 3] for i in range(0, len(text), 3)]
        some = lambda n: " ".join(rng.choice(words).strip(".,。、，") for _ in range(n))
        keys = [some(2) for _ in range(8)]
        link = lambda: f"https://www.{rng.randrange(99999)}.example/{rng.randrange(999)}"
        half = text[: len(text) // 2] + "."
        out += [(text, 0), (text + "\n\n" + text[len(text) // 3 :] + "\n" + link(), 0), (half, 0), (some(3), 0)]
        out += [("\n".join(f"[00:0{k}] {line}." for k, line in enumerate(text.split(","))), 0), (" ".join(str(rng.randrange(10**n)) for n in (3, 9, 6, 4)), 0)]
        clauses = [c.strip(" .。،") for c in re.split(r"[,、，،।]", text)]
        for sep in (", ", ".\n", ". "):
            for n in (1, 3):
                out.append((sep.join(rng.choice(clauses) for _ in range(n * len(clauses))) + ".", 0))
        for sep in (", ", " / ", " • ", " > ", "\n", " | "):
            out.append((sep.join(f"{rng.choice(keys)} {some(1)} {rng.randrange(999)}" for _ in range(rng.randrange(12, 40))), 1))
            out.append((half + "\n\n" + sep.join(f"{rng.choice(keys)} {rng.choice([some(1), rng.randrange(999)])}" for _ in range(rng.randrange(30, 60))), 1))
        for sep in (" ", "\n"):
            out.append((sep.join(link() for _ in range(15)), 1))
            out.append((sep.join(f"{rng.choice(keys)} {link()}" for _ in range(20)), 1))
            out.append((sep.join("#" + some(2).replace(" ", "_") for _ in range(30)), 1))
            out.append((sep.join(rng.choice(keys[:4]) for _ in range(60)), 1))
        few = some(8).split()
        out.append((". ".join(" ".join(rng.sample(few, min(3, len(few)))) for _ in range(40)) + ".", 1))
        key = keys[0]
        out.append((" ".join(f"{key} {some(1)} {key}, {key} {some(1)}, {some(2)} {key}." for _ in range(10)), 1))
    return list(dict.fromkeys(out))


def _host(url: str, source: str) -> Column:
    address = F.regexp_extract(F.col(url), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]+)", 1)
    return F.coalesce(F.nullif(F.lower(address), F.lit("")), F.lower(F.col(source)), F.lit(""))


def _feature_rows(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t or "") for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


class Held(NamedTuple):
    """Labelled pages that grew no trees: what the trees say of them, their labels and their hosts."""

    p: np.ndarray
    y: np.ndarray
    hosts: list[str]


def train(df: DataFrame, key: str = "doc_id", text: str = "text", url: str = "url", source: str = "source", sample: int = SAMPLE) -> tuple[Forest, Held]:
    """Trees grown on the weak labels of a sample and on ``seed_pages``, and the part of it that is held out.

    Signals and features of the sample are worked out where the texts are; only those come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.float64())
        for b in batches:
            texts = b.column(2).to_pylist()
            x, s = _feature_rows(texts), np.array([signals(t) for t in texts]).reshape(-1, len(SIGNALS))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x.tolist(), type=lists), pa.array(s.tolist(), type=lists)], names=["h", "host", "x", "s"])

    given = df.select(key, _host(url, source).alias("host"), text).where(F.length(F.trim(text)) > 0)
    rows = drawn(given, key, sample, lambda rows: rows.select("h", "host", text).mapInArrow(run, "h bigint, host string, x array<double>, s array<double>"))
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    y = weak_labels(np.array([r["s"] for r in rows]).reshape(-1, len(SIGNALS)))
    known = np.flatnonzero(y >= 0)
    kept = np.random.default_rng(5).random(len(known)) >= HELD_OUT
    seeds = seed_pages()
    grown, held = known[kept], known[~kept]
    forest = Forest(np.concatenate([x[grown], _feature_rows([t for t, _ in seeds])]), np.concatenate([y[grown], [k for _, k in seeds]]).astype(np.float64), trees=TREES, depth=DEPTH)
    return forest, Held(forest.predict(x[held]), y[held], [rows[i]["host"] for i in held])


def scored(df: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text", url: str = "url", source: str = "source") -> DataFrame:
    """Rows (key, host, p): the page's own probability of spam, 0 for null, empty and blank texts.

    The host is that of the url, else the source, else empty.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                texts = part.column(2).to_pylist()
                p = forest.predict(_feature_rows(texts))
                p[[not (t and t.strip()) for t in texts]] = 0.0
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p)], names=[key, "host", "p"])

    return df.select(key, _host(url, source).alias("host"), text).mapInArrow(run, f"`{key}` {kind}, host string, p double")


def _logit(p: np.ndarray | float) -> np.ndarray | float:
    p = np.clip(p, 0.01, 0.99)
    return np.log(p / (1 - p))


def host_weight(held: Held, rates: dict[str, tuple[float, float]], mean: float) -> float:
    """The weight of the hosts' rates that makes the labels of the held-out pages likeliest; 0 unless it is clearly better than none.

    ``rates`` has the sum of the probabilities of a host's pages and their number. Clearly better is a gain in
    log likelihood of three times its standard error.
    """
    if not len(held.p):
        return 0.0
    total, n = (np.array([rates.get(h, (0.0, 0.0))[i] for h in held.hosts]) for i in (0, 1))
    own = np.minimum(n, 1)
    rate = (total - own * held.p + HOST_SMOOTHING * mean) / (np.maximum(n - 1, 0) + HOST_SMOOTHING)
    shift = _logit(rate) - _logit(mean)
    sign = np.where(held.y == 1, 1.0, -1.0)
    loss = {w: np.log1p(np.exp(-sign * (_logit(held.p) + w * shift))) for w in HOST_WEIGHTS}
    best = min(HOST_WEIGHTS, key=lambda w: loss[w].mean())
    gain = loss[0.0] - loss[best]
    return best if gain.mean() > 3 * gain.std() / math.sqrt(len(gain)) else 0.0


def spam_pages(df: DataFrame, key: str = "doc_id", text: str = "text", url: str = "url", source: str = "source", sample: int = SAMPLE) -> DataFrame:
    """Rows (key, host, p, host_rate, score, spam) of all rows of ``df``.

    ``score`` moves the page's log odds by those of its host's rate against the rate of all pages, times a weight
    fitted on held-out pages; ``host_rate`` is that of the host's other pages, smoothed towards all. Pages of
    ``SPAM`` and more are spam. Null, empty and blank texts score 0 and are no spam; repeated rows and null
    keys stay as they are; further columns are ignored; an empty table gives an empty table.

    Texts meet Python in a narrow Arrow stage; its small result is written to the shared
    folder, as both the rates and the join read it. Rates are pre-aggregated before the
    shuffle and joined with salted rows, so one host may hold most pages.
    """
    spark = df.sparkSession
    forest, held = train(df, key, text, url, source, sample)
    pages = checkpointed(scored(df, forest, key, text, url, source))
    mean = pages.agg(F.coalesce(F.avg("p"), F.lit(0.0)).alias("mean")).first()["mean"]
    totals = pages.groupBy(F.col("host").alias("__host")).agg(F.sum("p").alias("__sum"), F.count("*").alias("__n"))
    asked = spark.createDataFrame([(h,) for h in sorted(set(held.hosts))], "__asked string")  # no more than the sample
    rates = {r["__host"]: (r["__sum"], float(r["__n"])) for r in totals.join(F.broadcast(asked), F.col("__host") == F.col("__asked")).collect()}
    weight = host_weight(held, rates, mean)
    joined = salted_left_join(pages, totals, {"host": "__host"})
    rate = (F.col("__sum") - F.col("p") + HOST_SMOOTHING * mean) / (F.col("__n") - 1 + HOST_SMOOTHING)
    odds = lambda c: let(F.least(F.greatest(c, F.lit(0.01)), F.lit(0.99)), lambda q: F.log(q / (1 - q)))
    moved = odds(F.col("p")) + weight * (odds(F.col("host_rate")) - float(_logit(mean)))
    score = F.when(F.col("p") > 0, 1 / (1 + F.exp(-moved))).otherwise(0.0)
    return joined.withColumn("host_rate", rate).drop("__host", "__sum", "__n").withColumn("score", score).withColumn("spam", F.col("score") >= SPAM)

"""Languages of segments and their parts: rank-order profiles of n-grams."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.columns import hash_edge
from sparkseg.llm.spoken import ALSO_WORDS, HESITATIONS, UNSPACED, unmarked, with_speech
from sparkseg.operators.skew import salted_left_join
from sparkseg.session import checkpointed

LANGUAGES = ("en", "ko", "es", "ja", "zh", "fr", "de", "it", "pt", "ru", "ar", "hi")
#: Labelled segments from which the profiles are made: those of the least hashes of seg_id.
SAMPLE = 12_000
#: N-grams of a profile; longest n-gram.
PROFILE, LONGEST_GRAM = 4000, 4
#: Out-of-place distance of an n-gram that a profile lacks: the farthest there is.
MISSING = PROFILE
#: What is none of the languages, and the mean distance of a text's n-grams from which it is that: for a language with little text, the share of
#: n-grams that it may be expected not to have shown yet, and ``BEYOND``, if that is more.
OTHER, FAR, BEYOND = "und", 0.55, 0.35
#: Share of an n-gram's frequency in the language that has it most, below which it is taken for a wrong label's.
NOISE = 0.03
#: Nats of one missing n-gram.
SCALE = 2.0
#: Nats against a language that isn't the recording's, isn't the label's, against a change within a text, and against no language.
NOT_PRIOR, NOT_DECLARED, CHANGE, NOT_ANY = 5.0, 3.0, 5.0, 8.0
#: Share of the sample on which the confidence is fitted, and the factors of the distances that are tried.
HELD_OUT, HEATS = 4, (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0)
#: Words (characters in Chinese and Japanese) that a language needs to make a text mixed.
MIXED_WORDS, MIXED_CHARACTERS = 3, 6
#: Latin words in a row that part a text of another script.
LATIN_RUN = 4
REMEMBERED = 200_000
BATCH = 2048

# fixed values: codes and names of the languages; the first part of a locale is looked up too
NAMES = {
    "en": "en eng english",
    "ko": "ko kor korean 한국어",
    "es": "es spa spanish español espanol castellano",
    "ja": "ja jpn japanese 日本語",
    "zh": "zh zho chi chinese 中文 汉语 漢語 普通话 cmn mandarin",
    "fr": "fr fra fre french français francais",
    "de": "de deu ger german deutsch",
    "it": "it ita italian italiano",
    "pt": "pt por portuguese português portugues",
    "ru": "ru rus russian русский",
    "ar": "ar ara arabic العربية",
    "hi": "hi hin hindi हिन्दी हिंदी",
}

# fixed values: the first article of the Universal Declaration of Human Rights, so that each profile has something
SEEDS = {
    "en": "all human beings are born free and equal in dignity and rights. they are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
    "es": "todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。",
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "fr": "tous les êtres humains naissent libres et égaux en dignité et en droits. ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité.",
    "de": "alle menschen sind frei und gleich an würde und rechten geboren. sie sind mit vernunft und gewissen begabt und sollen einander im geist der brüderlichkeit begegnen.",
    "it": "tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "pt": "todos os seres humanos nascem livres e iguais em dignidade e em direitos. dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade.",
    "ru": "все люди рождаются свободными и равными в своем достоинстве и правах. они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء.",
    "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
}

_SCRIPTS = (
    ("latin", "A-Za-zÀ-ɏ", ("en", "es", "fr", "de", "it", "pt")),
    ("hangul", "ᄀ-ᇿ㄰-㆏가-힣", ("ko",)),
    ("kana", "ぁ-ゖァ-ヺー", ("ja",)),
    ("han", "㐀-䶿一-鿿", ("zh", "ja")),
    ("cyrillic", "Ѐ-ӿ", ("ru",)),
    ("arabic", "؀-ۿ", ("ar",)),
    ("devanagari", "ऀ-ॣ०-ॿ", ("hi",)),
)
# beside other scripts, Latin letters count in whole words of small letters only: names don't
_FIND = {name: re.compile(f"[{span}]") for name, span, _ in _SCRIPTS} | {"small": re.compile(r"(?<![^\s\"'(,、，])[a-zß-ɏ]+(?![^\s\"'),.!?…、，。？])")}
_OTHER = re.compile("[" + "".join(span for name, span, _ in _SCRIPTS if name != "latin") + "]")
_CANDIDATES: dict[str, tuple[str, ...]] = {name: languages for name, _, languages in _SCRIPTS} | {"other": ()}
# dots of hesitation end no sentence
_SENTENCE = re.compile(r"(?:(?<=[^.][.])(?=\s)|(?<=[!?।؟])(?=\s)|(?<=[。！？]))[\s\"'»”」)]*(?=\S)")
_LATIN_RUN = re.compile(rf"((?:(?<![^\s\"'(])[A-Za-zÀ-ɏ'’,-]+[.!?,;]*(?:\s+|$)){{{LATIN_RUN},}})")
_TOKEN = re.compile(r"[ऀ-ॣ०-ॿ]+|[^\W\d_]+(?:['’][^\W\d_]+)*")
_QUIET = frozenset(w for w in HESITATIONS + ["um", "er"])
_DOUBTFUL = frozenset(ALSO_WORDS)
_UNSPACED = re.compile("|".join(UNSPACED) + r"|[嗯呃额唔](?=[…、，,.。\s]|$)")


def declared(language: Column) -> Column:
    """The two-letter code that a label names by code, locale or name; null for any other."""
    table = F.create_map(*[F.lit(x) for code, names in NAMES.items() for name in names.split() for x in (name, code)])
    key = F.regexp_replace(F.lower(language), r"^\s+|\s+$", "")
    return F.coalesce(table[key], table[F.regexp_extract(key, r"^([a-z]{2,3})[-_ ]", 1)])


def sentences(text: str) -> list[str]:
    """Sentences, parted once more where Latin words in a row stand within another script."""
    out = []
    for s in _SENTENCE.split(text):
        if not s.isascii() and _OTHER.search(s) and _LATIN_RUN.search(s):
            out += [p for p in _LATIN_RUN.split(s) if p.strip()]
        elif s.strip():
            out.append(s)
    return out


def script(sentence: str) -> tuple[str, int, float]:
    """The script of most letters, their number, and its share.

    Letters of scripts that none of the languages uses are "other". Kana make Han letters Japanese. Beside other scripts, Latin letters count a third, and those
    of names and of words joined to other letters don't count.
    """
    if sentence.isascii():
        n = sum(map(str.isalpha, sentence))
        return "latin", n, 1.0
    counts = {name: len(_FIND[name].findall(sentence)) for name, _, _ in _SCRIPTS}
    strange = sum(map(str.isalpha, sentence)) - sum(counts.values())
    if strange > sum(counts.values()):
        return "other", strange, 1.0
    if counts["latin"] and sum(counts.values()) > counts["latin"]:
        counts["latin"] = sum(map(len, _FIND["small"].findall(sentence)))
    if counts["kana"] and counts["kana"] * 8 >= counts["han"]:
        counts["kana"] += counts.pop("han")
    weight = {name: n / 3 if name == "latin" else n for name, n in counts.items()}
    best = max(weight, key=lambda k: weight[k])
    total = sum(weight.values())
    return best, counts[best], weight[best] / total if total else 0.0


def spoken_tokens(sentence: str, latin: bool) -> list[str]:
    """Lower-case words without hesitations and, in Latin script, without names (capitals behind the first word)."""
    words = _TOKEN.findall(sentence)
    if latin and len(words) > 3:
        kept = [w for i, w in enumerate(words) if i == 0 or w[0].islower()]
        words = kept if len(kept) > 1 else words
    return [w for w in (w.lower() for w in words) if w not in _QUIET]


def grams(word: str) -> list[str]:
    """N-grams of a word with an underscore at each end."""
    padded = f"_{word}_"
    return [*word, *(padded[i : i + n] for n in range(2, LONGEST_GRAM + 1) for i in range(len(padded) - n + 1))]


_CODES = (*LANGUAGES, OTHER)
_INDEX = {code: k for k, code in enumerate(LANGUAGES)}


class Profiles:
    """Rank of each n-gram in each language; n-grams are numbered by their overall frequency."""

    def __init__(self, counts: dict[str, Counter]):
        ranked = {code: [g for g, _ in sorted(counts[code].items(), key=lambda x: (-x[1], x[0]))[:PROFILE]] for code in LANGUAGES}
        share: Counter = Counter()
        for code in LANGUAGES:
            total = max(1, sum(counts[code].values()))
            for g in ranked[code]:
                share[g] += counts[code][g] / total
        self.number = {g: i for i, (g, _) in enumerate(sorted(share.items(), key=lambda x: (-x[1], x[0])))}
        self.rank = np.full((max(1, len(self.number)), len(LANGUAGES)), PROFILE, dtype=np.int64)
        for k, code in enumerate(LANGUAGES):
            for r, g in enumerate(ranked[code]):
                self.rank[self.number[g], k] = r
        self.far = np.array([max(FAR, BEYOND + unseen(counts[code])) for code in LANGUAGES])
        self.heat = 1.0
        self.words: dict[str, tuple[np.ndarray, int]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "words": {}}

    def known(self, word: str) -> tuple[np.ndarray, int]:
        """Numbers of the n-grams of a word that some profile has, and how many different others it has."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            every = [(g, self.number.get(g)) for g in grams(word)]
            own = np.array([i for _, i in every if i is not None], dtype=np.int64)
            found = self.words[word] = own, len({g for g, i in every if i is None})
        return found

    def distances(self, texts: list[list[str]], languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
        """Out-of-place distance of each text, a list of words, to each of the languages."""
        return self.measured(texts, languages)[0]

    def measured(self, texts: list[list[str]], languages: tuple[str, ...] = LANGUAGES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances, different n-grams that some profile has, and n-grams that none has, of each text.

        A text's n-grams are ranked by frequency, ties by overall frequency; each adds the
        difference of its ranks in units of ``MISSING``, 1 if the profile lacks it. N-grams that
        no profile has would add 1 to all and are counted apart.
        """
        out, kinds = np.zeros((len(texts), len(languages))), np.zeros(len(texts))
        strange = np.array([sum(self.known(w)[1] for w in set(words)) for words in texts], dtype=np.float64)
        parts = [(i, self.known(w)[0]) for i, words in enumerate(texts) for w in words]
        if not parts:
            return out, kinds, strange
        owner = np.repeat(np.array([i for i, _ in parts]), [len(a) for _, a in parts])
        each = np.concatenate([a for _, a in parts])
        if not len(each):
            return out, kinds, strange
        size = len(self.rank)
        keys, count = np.unique(owner * size + each, return_counts=True)
        owner, gram = keys // size, keys % size
        # unique keys are ordered by text and number already: a stable sort by count keeps that among equals
        order = np.argsort(owner * (int(count.max()) + 1) - count, kind="stable")
        owner, gram = owner[order], gram[order]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lengths = np.diff(np.r_[starts, len(owner)])
        place = np.arange(len(owner)) - np.repeat(starts, lengths)
        kinds[owner[starts]] = lengths
        for k, code in enumerate(languages):
            rank = self.rank[gram, _INDEX[code]]
            apart = np.where(rank == PROFILE, MISSING, np.abs(rank - place))
            out[owner[starts], k] = np.add.reduceat(apart, starts) / MISSING
        return out, kinds, strange


def unseen(counts: Counter) -> float:
    """Share of a language's n-grams that its text hasn't shown, by those that came once (Good and Turing)."""
    total = sum(counts.values())
    return sum(1 for n in counts.values() if n == 1) / total if total else 1.0


def _costs(profiles: Profiles, found: list[tuple[str, int, float]], words: list[list[str]]) -> np.ndarray:
    """Nats against each language, and against none of them, for each sentence; infinite for those of another script.

    No language is as far from everything as ``Profiles.far`` says for the languages of the script.
    """
    costs = np.full((len(found), len(_CODES)), np.inf)
    rows: dict[str, list[int]] = defaultdict(list)
    for i, (name, _, _) in enumerate(found):
        rows[name].append(i)
    for name, own in rows.items():
        languages = _CANDIDATES[name]
        if not languages:
            costs[own, -1] = 0.0
            continue
        at = [_INDEX[c] for c in languages]
        apart, kinds, strange = profiles.measured([words[i] for i in own], languages)
        costs[np.ix_(own, at)] = SCALE * (apart + strange[:, None])
        costs[own, -1] = SCALE * profiles.far[at].max() * (kinds + strange)
    return costs


def _confidence(costs: np.ndarray, chosen: int, heat: float) -> float:
    """Share of the chosen language's likelihood, by distances alone; half where its script shows it to be an exception."""
    if not np.isfinite(costs[chosen]):
        return 0.5
    return float(1 / np.exp(np.clip(heat * (costs[chosen] - costs), None, 50)).sum())


def _path(costs: np.ndarray, bias: np.ndarray) -> list[int]:
    """The cheapest language of each sentence: costs, bias once a run, and ``CHANGE`` a change."""
    total, back = costs[0] + bias, []
    for c in costs[1:]:
        switch = int(np.argmin(total))
        changed = total[switch] + CHANGE + bias
        back.append(np.where(total <= changed, np.arange(len(total)), switch))
        total = np.minimum(total, changed) + c
    k = int(np.argmin(total))
    path = [k]
    for b in reversed(back):
        k = int(b[k])
        path.append(k)
    return path[::-1]


def parts_of(texts: list[str], priors: list[str | None], labels: list[str | None], profiles: Profiles) -> list[list[tuple[str, float, str]]]:
    """For each text its parts (language, confidence, text) in order.

    Sentences without letters of a known script belong to their neighbours. The language of
    each is the cheapest path through the sentences; confidence is the share of the chosen
    language's likelihood by the distances alone, whatever the recording and the label say, fitted on held-out
    segments. A language with too few words to make the text mixed gives way to that of its neighbours.
    """
    cut: list[list[str]] = []
    found: list[tuple[str, int, float]] = []
    words: list[list[str]] = []
    spans: list[tuple[int, int]] = []
    for text in texts:
        if not text.isascii():
            text = _UNSPACED.sub(" ", text)
        kept = []
        begin = len(found)
        for s in sentences(text):
            about = script(s)
            own = spoken_tokens(s, about[0] == "latin") if about[1] else []
            if not own:
                if kept:
                    kept[-1] += " " + s
                continue
            kept.append(s)
            found.append(about)
            words.append(own)
        if len(found) - begin == 1 and _DOUBTFUL.issuperset(words[-1]):
            # nothing but sounds that may be hesitations
            kept = []
            del found[begin:], words[begin:]
        cut.append(kept)
        spans.append((begin, len(found)))
    costs = _costs(profiles, found, words)
    out = []
    for kept, (a, b), prior, label in zip(cut, spans, priors, labels):
        if a == b:
            out.append([])
            continue
        bias = np.zeros(len(_CODES))
        bias[-1] = NOT_ANY
        for code, nats in ((prior, NOT_PRIOR), (label, NOT_DECLARED)):
            if code in _INDEX:
                bias += nats
                bias[_INDEX[code]] -= nats
        path = [int(np.argmin(costs[a] + bias))] if b - a == 1 else _path(costs[a:b], bias)
        if len(set(path)) > 1:
            path = _settled(path, found[a:b], words[a:b])
        parts: list[tuple[str, float, str]] = []
        i = 0
        while i < len(path):
            j = i
            while j < len(path) and path[j] == path[i]:
                j += 1
            sure = _confidence(costs[a + i : a + j].sum(axis=0), path[i], profiles.heat)
            parts.append((_CODES[path[i]], sure, " ".join(kept[i:j]).strip()))
            i = j
        out.append(parts)
    return out


def _settled(path: list[int], found: list[tuple[str, int, float]], words: list[list[str]]) -> list[int]:
    """The path without languages of too few words; those sentences go with the language of most words."""
    size: dict[int, float] = defaultdict(float)
    for k, about, own in zip(path, found, words):
        unspaced = _CODES[k] in ("ja", "zh")
        size[k] += about[1] / MIXED_CHARACTERS if unspaced else len(own) / MIXED_WORDS
    most = max(size, key=lambda k: size[k])
    return [k if size[k] >= 1 or k == most else most for k in path]


def build_profiles(rows: list[tuple[str, str]]) -> Profiles:
    """Profiles from (text, label) pairs, some labelled wrongly.

    Sentences count for their label if it is a language of their script. An n-gram that another
    language has far more often is there by wrong labels and is left out.
    """
    counts = {code: Counter(g for w in _TOKEN.findall(seed) for g in grams(w)) for code, seed in SEEDS.items()}
    for text, label in rows:
        for s in sentences(text):
            name = script(s)[0]
            if label in _CANDIDATES[name]:
                for w in spoken_tokens(s, name == "latin"):
                    counts[label].update(grams(w))
    total = {code: max(1, sum(c.values())) for code, c in counts.items()}
    most: dict[str, float] = {}
    for code, c in counts.items():
        for g, n in c.items():
            most[g] = max(most.get(g, 0.0), n / total[code])
    return Profiles({code: Counter({g: n for g, n in c.items() if n / total[code] >= NOISE * most[g]}) for code, c in counts.items()})


def calibrated(profiles: Profiles, rows: list[tuple[str, str]]) -> Profiles:
    """The profiles with the factor of the distances that makes the labels of (text, label) pairs likeliest."""
    runs = []
    for text, label in rows:
        told = [(about, own) for about, own in ((x, spoken_tokens(s, x[0] == "latin")) for s, x in ((s, script(s)) for s in sentences(text)) if x[1]) if own]
        if told and all(label in _CANDIDATES[about[0]] for about, _ in told):
            runs.append((_costs(profiles, [a for a, _ in told], [o for _, o in told]).sum(axis=0), _INDEX[label]))
    if runs:
        loss = {heat: np.mean([-np.log(max(1e-9, _confidence(costs, k, heat))) for costs, k in runs]) for heat in HEATS}
        profiles.heat = min(HEATS, key=lambda heat: loss[heat])
    return profiles


def readable(df: DataFrame, *more: str) -> DataFrame:
    """Rows (seg_id, rec_id, label, more, body): each text without marks and label, and its declared code.

    What looks like a name label at the beginning is left out, whether or not the recording has
    the name: it tells nothing about the language.
    """
    read = with_speech(df.where("text IS NOT NULL").select("seg_id", "rec_id", declared(F.col("language")).alias("label"), "text", *more))
    return read.select("seg_id", "rec_id", "label", *more, unmarked(F.col("body_named")).alias("body"))


def priors(df: DataFrame) -> DataFrame:
    """Rows (rec_id, prior): the most frequent declared language of each recording, the greatest code of equals.

    Counted map-side first, so a recording may hold most rows.
    """
    labels = df.select("rec_id", declared(F.col("language")).alias("c")).where("rec_id IS NOT NULL AND c IS NOT NULL").groupBy("rec_id", "c").agg(F.count("*").alias("n"))
    return checkpointed(labels.groupBy("rec_id").agg(F.max(F.struct("n", "c"))["c"].alias("prior")))  # read for training and for all segments


def _with_prior(rows: DataFrame, prior: DataFrame) -> DataFrame:
    return salted_left_join(rows, prior.withColumnRenamed("rec_id", "__rec"), {"rec_id": "__rec"}).drop("__rec")


def trained(df: DataFrame, prior: DataFrame, sample: int = SAMPLE) -> Profiles:
    """Profiles from at most ``sample`` segments labelled like their recording, the same on every run; one in ``HELD_OUT`` fits the confidence.

    They are those of the least hashes of seg_id. A share of the rows that holds them almost
    surely is cut out by hash before the sort, so that the sort doesn't grow with the table.
    """
    labelled = df.where("text IS NOT NULL AND rec_id IS NOT NULL").withColumn("__label", declared(F.col("language"))).where("__label IS NOT NULL")
    share = 3.0 * sample / max(1, labelled.count())
    hashed = labelled.select("seg_id", "rec_id", "language", "__label", "text", F.xxhash64("seg_id").alias("h"))

    def least(rows: DataFrame) -> list:
        agreed = _with_prior(rows, prior).where("__label = prior")
        return readable(agreed.orderBy("h", "text").limit(sample)).select("body", "label").collect()

    rows = least(hashed.where(F.col("h") <= hash_edge(share)))
    if len(rows) < sample and share < 1:
        rows = least(hashed)
    pairs = [(r["body"], r["label"]) for r in rows]
    held = pairs[::HELD_OUT]
    return calibrated(build_profiles([p for i, p in enumerate(pairs) if i % HELD_OUT]), held)


def identify(df: DataFrame, sample: int = SAMPLE, texts: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (seg_id, label, part, lang, confidence, text, keep): each part of each segment with spoken words.

    ``df`` has seg_id, rec_id, language, text. Parts are runs of sentences in one language;
    ``lang`` is ``OTHER`` for what is none of the languages; ``label`` is the code of ``language``, null if that is missing or unusable. Null, empty and
    wordless texts have no row; a null rec_id has no prior language; redelivered rows come as
    often as they are; further columns are ignored but those of ``keep``; an empty table gives an empty table. ``text``
    is null unless ``texts``.

    The prior of a recording is its most frequent label, joined with salted rows. The profiles, of
    bounded size, are broadcast.
    """
    prior = priors(df)
    shipped = df.sparkSession.sparkContext.broadcast(trained(df, prior, sample))
    joined = _with_prior(readable(df, *keep), prior).select("seg_id", "label", "prior", "body", *keep)
    kind = df.schema["seg_id"].dataType.simpleString()
    kept = "".join(f", `{k}` {df.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                b = batch.slice(at, BATCH)
                found = parts_of(b.column(3).to_pylist(), b.column(2).to_pylist(), b.column(1).to_pylist(), shipped.value)
                of = pa.array([i for i, parts in enumerate(found) for _ in parts], type=pa.int32())
                flat = [(k, *p) for parts in found for k, p in enumerate(parts)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(of), b.column(1).take(of), pa.array([f[0] for f in flat], type=pa.int32()), pa.array([f[1] for f in flat], type=pa.string()), pa.array([f[2] for f in flat], type=pa.float64()), pa.array([f[3] if texts else None for f in flat], type=pa.string()), *[b.column(4 + i).take(of) for i in range(len(keep))]],
                    names=["seg_id", "label", "part", "lang", "confidence", "text", *keep],
                )

    return joined.mapInArrow(run, f"seg_id {kind}, label string, part int, lang string, confidence double, text string{kept}")


def first_delivered(parts: DataFrame, at: str = "ingested_at") -> DataFrame:
    """``parts``, each of a segment once: those of its first delivery, of equal times the least label; rows without a time come last."""
    row = F.struct(*[F.col(f"`{c}`") for c in parts.columns])
    place = F.struct(F.col(at).isNull(), at, F.coalesce("label", F.lit("")), F.coalesce("text", F.lit("")))
    return parts.groupBy("seg_id", "part").agg(F.min_by(row, place).alias("r")).select("r.*")


def mislabelled(parts: DataFrame, at: str | None = None) -> DataFrame:
    """Rows (seg_id, lang) of segments whose label is missing or wrong, or that are mixed, by their first delivery, given its time ``at``.

    What is none of the languages has no row.
    """
    first = F.min_by(F.struct("label"), F.struct(F.col(at).isNull(), at, F.coalesce("label", F.lit(""))))["label"] if at else F.min("label")
    per = parts.groupBy("seg_id").agg(F.collect_set("lang").alias("langs"), first.alias("label"))
    wrong = F.col("label").isNull() | (F.size("langs") > 1) | (F.col("langs")[0] != F.col("label"))
    return per.where(wrong).select("seg_id", F.explode("langs").alias("lang")).where(F.col("lang") != OTHER)

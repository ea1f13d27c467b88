"""Abusive, hateful or sexual content by class-conditional Kneser-Ney models.

Two trigram models, one of abusive and one of ordinary sentences, are smoothed with absolute discounts down to class unigrams
and from there to counts that both share, so an expression neither class knows favours none. A sentence's score is the
difference of its log-likelihoods divided by its length, a document's the highest of its sentences and windows.

The models are fitted on reviewed documents. A review only says that a document is abusive somewhere, so the sentences are
found first: in each abusive document the sentence that the models of the other reviews rate highest; documents whose reviews
the models of the others contradict clearly are left out, as some verdicts are wrong. Threshold and models come from the
reviews alone.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Letters of other scripts that are drawn like Latin ones (fixed values).
LOOKALIKES = str.maketrans("авеёікмнорстухѕјһԁɡαβεικνορτυχ", "abeeikmhopctyxsjhdgabeiknoptux")
#: Digits and signs that stand for letters.
LEET = str.maketrans("0134578@$!|", "oleastbasil")
_ONE_AS_I = str.maketrans("1", "i")
_UNIT = re.compile(r"[.!?。！？…]+(?:\s+|$)|[。！？…]|[\n\r;]+|<br\s*/?>|</?\w+>")
_TOKEN = re.compile(r"[぀-ヿ㐀-鿿가-힯]|[^\W_぀-ヿ㐀-鿿가-힯][^\W぀-ヿ㐀-鿿가-힯]*(?:[*@$!|#]+[^\W_]+)*|[*#@$]{2,}")
_SPACED = re.compile(r"(?<![\w*])(?:[^\W\d_][ .\-_*·|/]){2,}[^\W\d_](?![\w*])")
_RUN = re.compile(r"(.)\1{2,}")
_BOS, _RARE, _NUM, _MASK = "<s>", "<rare>", "<num>", "<masked>"
DISCOUNT, CLIP = 0.75, 7.0
#: Reviewed documents used at most, those with the smallest hash of their id, and their characters together.
SAMPLE, SAMPLE_CHARS = 6000, 50_000_000
WINDOW, SHORTNESS = 12, 4
#: A word must stand in this share of the reviewed documents (and in two) to be known.
RARE_SHARE = 0.001
#: Plain expressions of either kind, so that small samples of reviews have a start; each counts as one sentence.
SEEDS = (
    "you stupid idiot", "you are an idiot", "you are a moron", "what a complete moron", "you pathetic loser", "you worthless piece of trash", "shut up you fool", "shut your mouth", "go to hell you bastard", "you disgusting pig", "you filthy scum", "you useless asshole",
    "fuck you", "go fuck yourself", "screw you", "you dumb bitch", "you retarded imbecile", "kill yourself", "go die", "i will kill you", "i will find you and hurt you", "i know where you live", "i hope you die", "somebody should beat you", "nobody would miss you", "you deserve to suffer",
    "they are vermin", "they are parasites", "they are all thieves", "they breed like animals", "they are subhuman", "they are not human", "they should be deported", "send them back", "throw them out", "they are inferior", "women are too stupid for this", "gays are a disease", "foreigners are criminals", "immigrants are a plague", "they do not deserve to live",
    "send me nudes", "naked girls", "hot horny girls are waiting for you", "hardcore porn videos", "free sex cams", "i want to fuck you", "come have sex with me tonight", "my wet pussy", "my hard cock", "big tits", "a blowjob", "explicit photos for sale", "she moaned as he pushed inside her",
    "eres un idiota", "hijo de puta", "vete a la mierda", "cállate imbécil", "las mujeres no sirven", "du bist ein arschloch", "halt die fresse", "du dummer idiot", "ausländer raus", "ta gueule connard", "va te faire foutre", "espèce de débile", "sale con", "seu idiota de merda", "vai se foder", "cala a boca", "filho da puta",
    "ты идиот", "пошёл нахуй", "заткнись ублюдок", "siktir git", "sen bir aptalsın", "kapa çeneni", "你这个废物", "你是个傻逼", "去死吧", "滚出去", "死ね", "黙れ馬鹿野郎", "お前はクズだ", "外国人は出て行け",
)
FAIR = (
    "the kill switch closed the trade", "a dead cat bounce", "dumb money kept buying", "selling naked puts is risky", "idiot proof settings", "i was stupid and lost money", "my own stupid mistake", "i am an idiot for holding", "this damn indicator repaints", "what a hell of a day", "damn i hate this chart", "shorts got slaughtered", "the trade got murdered by slippage", "penetration of the upper band",
    "no insults no hate speech no nudity", "do not call other members names", "a moderator removed abusive comments", "hate speech is not allowed here", "harassment will be reported", "the message was removed because it was offensive", "stop hunting sucks", "stripped bonds", "hot stock of the day", "adults and kids", "women and men traded equally", "rules for immigrants opening accounts", "these stocks deserve to die", "slippage kills the edge",
)


def plain(text: str) -> str:
    """Compatibility forms, lower case, no invisible characters and no marks on letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(ch for ch in text if unicodedata.category(ch) not in ("Mn", "Cf", "Me") or ch in "゙゚")
        text = unicodedata.normalize("NFC", text)
    return text.casefold()


def _latin(token: str) -> str:
    """Lookalikes become Latin in a word that also has Latin letters."""
    if not token.isascii() and any("a" <= ch <= "z" for ch in token):
        return token.translate(LOOKALIKES)
    return token


def units(text: str) -> list[list[str]]:
    """The raw tokens of the sentences and lines of a text; letters set apart are joined to a word with a leading ``+``."""
    out = []
    joined = _SPACED.sub(lambda m: " +" + re.sub(r"[^\w]|_", "", m[0]) + " ", plain(text))
    for piece in _UNIT.split(joined):
        if not piece:
            continue
        tokens = []
        for m in _TOKEN.finditer(piece):
            t = _latin(m[0])
            tokens.append("+" + t if m.start() and piece[m.start() - 1] == "+" else t)
        if tokens:
            out.append(tokens)
    return out


class Reader:
    """Maps raw tokens to the models' vocabulary, undoing disguises where that gives a known word."""

    def __init__(self, vocabulary: set[str], marked: Counter[str]) -> None:
        self.vocabulary, self.marked, self._known = vocabulary, marked, {}
        self.by_frame: dict[tuple[int, str, str], list[str]] = defaultdict(list)
        for w in marked:
            if len(w) >= 3:
                self.by_frame[len(w), w[0], w[-1]].append(w)

    def __call__(self, tokens: list[str]) -> list[str]:
        known, out = self._known, []
        if len(known) > 400_000:
            known.clear()
        for t in tokens:
            w = known.get(t)
            if w is None:
                w = known[t] = self._read(t)
            out.append(w)
        return out

    def _read(self, t: str) -> str:
        spaced = t.startswith("+")
        t = t.lstrip("+")
        v = self.vocabulary
        if t in v and not spaced:
            return t
        if t.isdigit():
            return _NUM
        for w in (t, t[1:]) if spaced else ():
            if w in v:
                return w
        if "*" in t or "#" in t:
            core = t.rstrip("!?")
            fits = [w for w in self.by_frame.get((len(core), core[0], core[-1]), ()) if all(a in "*#" or a == b for a, b in zip(core, w))]
            return max(fits, key=lambda w: self.marked[w]) if fits else _MASK if re.search(r"\w\*{2,}|\*{2,}\w", t) else _RARE
        for w in (_RUN.sub(r"\1\1", t), _RUN.sub(r"\1", t)):
            if w in v and len(w) > 1:
                return w
        if any(c.isalpha() for c in t) and any(c in "0134578@$!|" for c in t) or re.fullmatch(r"[\d@$]{3,}", t):
            for w in (t.translate(LEET), t.translate(_ONE_AS_I).translate(LEET), _RUN.sub(r"\1", t.translate(LEET))):
                if w in self.marked:
                    return w
        return _NUM if t[0].isdigit() else _RARE


class KneserNey:
    """An interpolated trigram model over one class's sentences; its unigrams back off to shared counts."""

    def __init__(self, sentences: Counter[tuple[str, ...]], shared: Counter[str]) -> None:
        tri: Counter[tuple[str, str, str]] = Counter()
        for s, n in sentences.items():
            s = (_BOS, _BOS, *s)
            for i in range(2, len(s)):
                tri[s[i - 2], s[i - 1], s[i]] += n
        bi = Counter((v, w) for _, v, w in tri)
        uni = Counter(w for _, w in bi)
        self.tri, self.bi, self.uni, self.shared = dict(tri), dict(bi), dict(uni), dict(shared)
        self.tri_total, self.tri_types, self.bi_total, self.bi_types = Counter(), Counter(), Counter(), Counter()
        for (u, v, _), n in tri.items():
            self.tri_total[u, v] += n
            self.tri_types[u, v] += 1
        for (v, _), n in bi.items():
            self.bi_total[v] += n
            self.bi_types[v] += 1
        self.uni_total, self.shared_total = max(1, sum(uni.values())), sum(shared.values()) + len(shared) + 1

    def log(self, u: str, v: str, w: str) -> float:
        d = DISCOUNT
        p = (self.shared.get(w, 0) + 1) / self.shared_total
        p = max(self.uni.get(w, 0) - d, 0) / self.uni_total + d * len(self.uni) / self.uni_total * p
        if n := self.bi_total.get(v, 0):
            p = max(self.bi.get((v, w), 0) - d, 0) / n + d * self.bi_types[v] / n * p
        if n := self.tri_total.get((u, v), 0):
            p = max(self.tri.get((u, v, w), 0) - d, 0) / n + d * self.tri_types[u, v] / n * p
        return math.log(max(p, 1e-12))


class Scorer:
    """Sentence and document scores of a pair of models."""

    def __init__(self, toxic: KneserNey, ordinary: KneserNey, reader: Reader, threshold: float = 0.0) -> None:
        self.toxic, self.ordinary, self.reader, self.threshold = toxic, ordinary, reader, threshold
        self._ratio: dict[tuple[str, str, str], float] = {}
        self._unit: dict[tuple[str, ...], float] = {}

    def sentence(self, s: tuple[str, ...]) -> float:
        if (known := self._unit.get(s)) is not None:
            return known
        if len(self._ratio) > 1_000_000:
            self._ratio.clear()
        if len(self._unit) > 300_000:
            self._unit.clear()
        ratios, (u, v) = [], (_BOS, _BOS)
        for w in s:
            key = (u, v, w)
            r = self._ratio.get(key)
            if r is None:
                r = self._ratio[key] = max(-CLIP, min(CLIP, self.toxic.log(u, v, w) - self.ordinary.log(u, v, w)))
            ratios.append(r)
            u, v = v, w
        best = sum(ratios) / (len(ratios) + SHORTNESS)
        if len(ratios) > WINDOW:
            total = sum(ratios[:WINDOW])
            best = max(best, total / (WINDOW + SHORTNESS))
            for i in range(WINDOW, len(ratios)):
                total += ratios[i] - ratios[i - WINDOW]
                best = max(best, total / (WINDOW + SHORTNESS))
        self._unit[s] = best
        return best

    def document(self, text: str | None) -> float:
        """Far below zero for texts without words."""
        if not text:
            return -CLIP
        return max((self.sentence(tuple(self.reader(u))) for u in units(text)), default=-CLIP)


def fit(documents: list[tuple[list[list[str]], bool]], folds: int = 3, rounds: int = 2) -> Scorer:
    """A scorer from reviewed documents: the raw tokens of their sentences, and whether they are abusive."""
    df, marked_df = Counter(), Counter()
    for us, bad in documents:
        ws = {w.lstrip("+") for u in us for w in u}
        df.update(ws)
        if bad:
            marked_df.update(ws)
    for texts, bad in ((SEEDS, True), (FAIR, False)):
        for t in texts:
            ws = {w for u in units(t) for w in u}
            df.update(ws)
            if bad:
                marked_df.update(ws)
    n, n_bad = len(documents) + len(SEEDS) + len(FAIR), sum(bad for _, bad in documents) + len(SEEDS)
    lift = lambda w: ((marked_df[w] + 0.1) / (n_bad + 1)) / ((df[w] - marked_df[w] + 0.1) / (n - n_bad + 1))
    least = max(2, round(n * RARE_SHARE))  # names of few documents aren't words
    vocabulary = {w for w, c in df.items() if c >= least and w.isalpha()} | {w for t in (*SEEDS, *FAIR) for u in units(t) for w in u}
    marked = Counter({w: marked_df[w] for w in vocabulary if lift(w) > 3 and marked_df[w]})
    reader = Reader(vocabulary, marked)
    read = [([tuple(reader(u)) for u in us], bad) for us, bad in documents]
    shared: Counter[str] = Counter()
    for us, _ in read:
        for u in us:
            shared.update(u)
    seeds = [tuple(reader(u)) for t in SEEDS for u in units(t)], [tuple(reader(u)) for t in FAIR for u in units(t)]
    for u in (*seeds[0], *seeds[1]):
        shared.update(u)
    weight = {w: math.log(lift(w)) for w in vocabulary}
    first = lambda s: sum(max(-1.0, weight.get(w, 0.0)) for w in s) / (len(s) + 2)
    n_bad -= len(SEEDS)
    n = len(read)
    chosen = [max(range(len(us)), key=lambda i: first(us[i]), default=None) if bad and us else None for us, bad in read]
    dropped, scores = [False] * n, [0.0] * n

    wrong: set[tuple[str, ...]] = set()  # abusive sentences that stand in documents reviewed as ordinary

    def models(keep) -> tuple[KneserNey, KneserNey]:
        toxic, ordinary = Counter(seeds[0]), Counter(seeds[1])
        for d, (us, bad) in enumerate(read):
            if keep(d) and not dropped[d]:
                for i, u in enumerate(us):
                    if i == chosen[d]:
                        toxic[u] += 1
                    elif u not in wrong:
                        ordinary[u] += 1
        return KneserNey(toxic, shared), KneserNey(ordinary, shared)

    for _ in range(rounds):
        picks, fair = list(chosen), Counter(u for us, bad in read if not bad for u in set(us))
        for f in range(folds):
            scorer = Scorer(*models(lambda d, f=f: d % folds != f), reader)
            for d in range(f, n, folds):
                us, bad = read[d]
                each = [scorer.sentence(u) for u in us]
                scores[d] = max(each, default=-CLIP)
                if bad and us:
                    picks[d] = max(range(len(us)), key=each.__getitem__)
        threshold = _cut([(s, bad) for s, (_, bad) in zip(scores, read)])
        chosen = picks
        dropped = [bad and s < threshold for s, (_, bad) in zip(scores, read)]
        found = Counter(read[d][0][i] for d, i in enumerate(chosen) if i is not None and not dropped[d])
        wrong = {u for u in found if fair[u]}  # on both sides: the side with fewer documents, by its size, is wrong
        for d, i in enumerate(chosen):
            if i is not None and (u := read[d][0][i]) in wrong and found[u] * (n - n_bad) <= fair[u] * n_bad * 2:
                chosen[d] = None
        wrong = {u for u in wrong if found[u] * (n - n_bad) > fair[u] * n_bad * 2}
    return Scorer(*models(lambda d: True), reader, threshold)


def _cut(scored: list[tuple[float, bool]]) -> float:
    """The threshold with the best F1 on scores of held-out documents, in the middle of the gap around it."""
    scored = sorted(scored, reverse=True)
    total = sum(bad for _, bad in scored) or 1
    best, at, hits = -1.0, 0.0, 0
    for i, (s, bad) in enumerate(scored, 1):
        hits += bad
        f1 = 2 * hits / (i + total)
        if f1 > best:
            best, at = f1, (s + scored[i][0]) / 2 if i < len(scored) else s - 0.1
    return at


def fitted(documents: DataFrame, reviews: DataFrame, record: str, text: str, verdict: str, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> bytes:
    """A pickled scorer from the reviewed rows of ``documents``: the mean of a document's verdicts decides, undecided ones and ties
    are left out. At most ``sample`` reviewed documents of ``sample_chars`` characters together are used, whole ones in the order of
    the hash of their id. One task fits; only the models reach the driver, whose size the sample bounds."""
    votes = reviews.where(F.col(verdict).isNotNull()).groupBy(F.col(record).alias("__id")).agg(F.avg(F.col(verdict).cast("double")).alias("__bad")).where("__bad <> 0.5")
    votes = votes.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = documents.select(F.col(record).alias("__id"), F.col(text).cast("string").alias("__text")).where("__text is not null").join(F.broadcast(votes), "__id")
    upto = F.sum(F.length("__text")).over(Window.orderBy(F.xxhash64("__id"), "__id", "__text"))  # over at most ``sample`` rows
    found = rows.withColumn("__upto", upto).where(F.col("__upto") <= sample_chars).select("__text", (F.col("__bad") > 0.5).alias("__abusive"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = [(units(t), bool(b)) for batch in batches for t, b in zip(batch["__text"], batch["__abusive"])]
        yield pd.DataFrame({"model": [pickle.dumps(fit(read))]})

    row = found.coalesce(1).mapInPandas(run, "model binary").first()
    return bytes(row[0]) if row else pickle.dumps(fit([]))  # without reviews, no task


def score(documents: DataFrame, scorer: Scorer | bytes, record: str, text: str, *keep: str) -> DataFrame:
    """(record, *keep, score, abusive) for each row: the score is length-normalised log-likelihood ratio minus the threshold, abusive
    whether it is above 0. Null and empty texts have a score far below 0 and aren't abusive. One pass without a shuffle; the
    model, bounded by the sample it was fitted on, is broadcast."""
    shared = documents.sparkSession.sparkContext.broadcast(scorer if isinstance(scorer, bytes) else pickle.dumps(scorer))
    rows = documents.select(record, *keep, F.col(text).cast("string").alias("__text"))
    schema = rows.select(record, *keep, F.lit(0.0).alias("score"), F.lit(True).alias("abusive")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pickle.loads(shared.value)
        for batch in batches:
            scores = [model.document(t if isinstance(t, str) else None) - model.threshold for t in batch["__text"]]
            yield batch.drop(columns="__text").assign(score=scores, abusive=[s > 0 for s in scores])

    return rows.mapInPandas(run, schema)


def rates(scored: DataFrame, source: str) -> DataFrame:
    """(source, documents, abusive, rate) of scored rows; a null source is a source of its own."""
    return scored.groupBy(source).agg(F.count("*").alias("documents"), F.count_if("abusive").alias("abusive"), (F.count_if("abusive") / F.count("*")).alias("rate"))

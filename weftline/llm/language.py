"""Languages of documents and of their segments, by Bayesian evidence fusion.

A text is cut into statements. Each statement's language, one of ``LANGS`` or ``other``, gets the posterior of
  * the likelihood of its letter triples under one model per language and, for ``other``, under a background of
    independent letters with a malus per triple, so that text which no model explains well belongs to none,
  * the number of its function words of each language,
  * the declared language (the label, and the ``lang`` attribute of the element that holds the statement), which is
    right with probability ``TRUST``,
  * the prior of the document's host: shares of declared languages per source, smoothed towards those of the source's
    address suffix (its part after the last ``.`` or ``-``), and these towards the shares of all documents.
The shares come from one grouped aggregation over all documents. The letter models are fitted on a sample of at most
about ``SAMPLE_PER_LABEL`` labelled documents per language (whole texts, drawn by a hash of the id), of which only
statements count whose function words agree with the label; the function words themselves are a small prior, so a
language without labelled documents is known as well. Script is evidence of its own: only Han letters without kana
are Chinese, and a statement mostly in another script than Latin or Han is ``other``.

A language is present in a document if it holds one statement of ``MIN_WORDS`` words (``MIN_HAN`` Han letters) with
posterior of at least ``SURE``. Neighbouring statements of one language form a segment.

Defined results: null and empty texts have no segments and the language of their prior; field names, numbers and
words with digits or underscores are no words; labels that name no single language count as no label; repeated rows
are handled one by one; an empty table gives an empty result. ``other`` is a language of segments and documents but
never a row of :func:`wrong_labels`, since it names none.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut

LANGS = ("en", "es", "fr", "de", "pt", "it", "zh")
OTHER = "other"
ALL = (*LANGS, OTHER)
ZH, NONE = LANGS.index("zh"), len(LANGS)
#: Prior of a statement in none of the languages, and the background's bonus per letter triple.
OTHER_PRIOR, OTHER_BONUS = 1e-3, -0.8
#: Share of a statement's words that are function words of its language, and of any other language.
OWN_WORDS, STRAY_WORDS = 0.25, 0.05
MIN_WORDS, MIN_HAN = 10, 12
SURE, TRUST = 0.9, 0.9
#: Bound of the labelled sample, per language.
SAMPLE_PER_LABEL = 1_500
BUCKETS = 1 << 16
#: Weight of the suffix's shares in a source's, and of all documents' in a suffix's, in documents.
SMOOTHING = 20.0
#: Letter triples overlap, so their evidence is weakened.
TEMPER = 3.0
#: Most sources whose priors are broadcast (about 100 bytes each); beyond it they are joined with salts.
BROADCAST_SOURCES = 100_000
SALTS = 32
_CHUNK = 400_000

# Function words, and names of the languages.
FUNCTION_WORDS = {
    "en": "the of and to in is was for with that by from are as it which on this be at not than has been should before after while because so although every",
    "es": "el la los las de del que y en con por para una un se no su más sin pero como ya aunque todavía según porque mientras después antes desde hasta todos",
    "fr": "le la les des du de et dans avec pour par une un est sur qui que ne pas plus sans mais bien tandis depuis avant après tous encore selon aux cette",
    "de": "der die das und den dem des ein eine ist mit auf für von nicht zu im wird aus bei nach noch mehr aber sondern während weil obwohl damit alle über",
    "pt": "o a os as do da dos das de que e em com por para uma um se não mais sem mas como ainda embora enquanto porque antes depois desde até todos pela no na",
    "it": "il lo la i gli le di del della dei che e in con per una un si non più senza ma come ancora anche mentre perché prima dopo dalla tutti nel nella al",
}
NAMES = {
    "en": "en eng english", "es": "es spa spanish español espanol castellano castilian", "fr": "fr fra fre french français francais",
    "de": "de deu ger german deutsch", "pt": "pt por portuguese português portugues", "it": "it ita italian italiano",
    "zh": "zh zho chi chinese mandarin cmn 中文 汉语 漢語",
}
CODES = {n: c for c, names in NAMES.items() for n in names.split()}

_END = re.compile(
    r"[.!?…。！？\n](?:(?<=[.!?…])(?![.!?…])[\"”“»’)\]]*+(?=\s)|(?<=[。！？])[”》」）]*|(?<=\n)(?:[ \t]*+(?:[>|][ \t]*+)?\n|(?=[ \t]*+(?:[-*#`•|>]|\d{1,3}[.)])[ \t`])))"
)
_TAG = re.compile(r"<[^<>]*+>")
_NUMERIC = re.compile(r"[\d_]")
_NOWORD = re.compile(r"[^\w'’]+")
_HAN = re.compile(r"[㐀-鿿]")
#: Letters of scripts other than Latin and Han: Greek, Cyrillic, Armenian, Hebrew, Arabic, the Indic and Thai block, Georgian, kana, Hangul.
_FOREIGN = re.compile(r"[\u0370-\u03ff\u0400-\u05ff\u0600-\u07ff\u0900-\u0fff\u10a0-\u11ff\u3040-\u30ff\uac00-\ud7af]")
_ELEMENT = re.compile(r"<(/?)([A-Za-z][\w:-]*+)([^<>]*+)>")
_MARKUP_LANG = re.compile(r"\blang\s*+=\s*+[\"']?([A-Za-z]{2,3})\b")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Latin letters and the blanks and marks between words, over which the background is spread.
_LATIN = "".join(chr(i) for i in range(0x61, 0x250) if chr(i).isalpha() and chr(i).islower()) + " '’"
_SETS = {c: frozenset(w.split()) for c, w in FUNCTION_WORDS.items()}
#: Each function word's row in the table of the languages that have it.
_ROW = {w: i for i, w in enumerate(sorted({w for ws in _SETS.values() for w in ws}))}
_LISTED = np.array([c in _SETS for c in ALL])
_HAS = np.array([[w in _SETS.get(c, ()) for c in ALL] for w in _ROW], float)


def label_language(label: Column) -> Column:
    """The supported language that a label names, or null."""
    low = F.lower(F.trim(label))
    stem = F.regexp_extract(F.translate(low, "_", "-"), r"^([^-\s,;/]+)(?:-[\w-]+)?$", 1)
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv]), stem)


def declared_elements(text: str) -> tuple[list[int], list[str | None]]:
    """Where the language declared by markup changes, and to what: that of the innermost open element with a ``lang``.

    An element without an end lasts to the end of the text. Linear in the text.
    """
    at, langs = [0], [None]
    if "<" not in text or "lang" not in text:
        return at, langs
    stack: list[list] = []  # name, language, open elements of the same name inside
    held: dict[str, int] = {}

    def now(pos: int) -> None:
        at.append(pos)
        langs.append(stack[-1][1] if stack else None)

    for m in _ELEMENT.finditer(text):
        name = m.group(2).lower()
        if not m.group(1):
            if name in _VOID or m.group(3).endswith("/"):
                continue
            found = _MARKUP_LANG.search(m.group(3))
            if found:
                stack.append([name, CODES.get(found.group(1).lower()), 0])
                held[name] = held.get(name, 0) + 1
                now(m.start())
            elif held.get(name) and stack[-1][0] == name:
                stack[-1][2] += 1
        elif held.get(name):
            while stack[-1][0] != name:
                held[stack.pop()[0]] -= 1
            if stack[-1][2]:
                stack[-1][2] -= 1
            else:
                held[stack.pop()[0]] -= 1
            now(m.end())
    return at, langs


def statements(text: str | None) -> list[tuple[int, int, str, int, int, int]]:
    """``start, end, plain words, number of words, of Han letters and of letters of other scripts`` of each statement."""
    out = []
    if not text:
        return out
    at = 0
    cuts = [m.end() for m in _END.finditer(text)]
    for end in [*cuts, len(text)]:
        raw = text[at:end]
        if raw.strip():
            if "<" in raw:
                raw = _TAG.sub(" ", raw)
            han = foreign = 0
            letters = raw
            if not raw.isascii():
                han, foreign = len(_HAN.findall(raw)), len(_FOREIGN.findall(raw))
                letters = unicodedata.normalize("NFC", raw)
                if han:
                    letters = _HAN.sub(" ", letters)
            kept = [w if w.isalpha() else _NOWORD.sub(" ", w) for w in letters.lower().split() if w.isalpha() or not _NUMERIC.search(w)]
            plain = " ".join(" ".join(kept).split())
            out.append((at, end, plain, plain.count(" ") + 1 if plain else 0, han, foreign))
        at = end
    return out


def _hash(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)) >> np.uint32(16)).astype(np.int64)


def _buckets(codes: np.ndarray) -> np.ndarray:
    c = codes.astype(np.uint32)
    return _hash(c[:-2], c[1:-1], c[2:])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def votes(plain: str) -> str | None:
    """The language with most function words in ``plain``, if it leads."""
    ws = plain.split()
    n = sorted(((sum(w in s for w in ws), c) for c, s in _SETS.items()), reverse=True)
    return n[0][1] if n[0][0] >= 2 and n[0][0] > n[1][0] else None


def sample_counts(docs: DataFrame) -> DataFrame:
    """Letter triples of the statements of labelled ``docs`` (``declared, text``): ``lang, bucket, n``; single letters under the number of ``other``."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        total = np.zeros((len(ALL), BUCKETS), np.int64)

        def add(lang: str, texts: list[str]) -> None:
            codes = _codes(" " + " ".join(texts) + " ")
            total[LANGS.index(lang)] += np.bincount(_buckets(codes), minlength=BUCKETS)
            total[NONE] += np.bincount(codes[codes < BUCKETS], minlength=BUCKETS)

        for b in batches:
            parts: dict[str, list[str]] = {c: [] for c in LANGS}
            for d, t in zip(b["declared"], b["text"]):
                for _, _, plain, words, _, _ in statements(t):
                    if words >= MIN_WORDS and d in _SETS and votes(plain) == d:
                        parts[d].append(plain)
                if len(parts[d]) > 2_000:
                    add(d, parts[d])
                    parts[d] = []
            for c, p in parts.items():
                if p:
                    add(c, p)
        i, j = np.nonzero(total)
        yield pd.DataFrame({"lang": i.astype("int32"), "bucket": j.astype("int32"), "n": total[i, j]})

    return docs.mapInPandas(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def letter_model(counts: DataFrame | None) -> np.ndarray:
    """Log probabilities of buckets by language and, last, of the background, ``BUCKETS x len(ALL)``; the table's size is fixed."""
    total = np.full((len(LANGS), BUCKETS), 0.05)
    letters = np.zeros(BUCKETS)
    for k, c in enumerate(LANGS):
        for w in FUNCTION_WORDS.get(c, "").split():
            np.add.at(total[k], _buckets(_codes(f" {w} ")), 5.0)
            np.add.at(letters, _codes(f" {w}").astype(np.int64), 1.0)
    if counts is not None:
        t = counts.toArrow()
        lang, bucket, n = t["lang"].to_numpy(), t["bucket"].to_numpy(), t["n"].to_numpy().astype(float)
        own = lang < len(LANGS)
        np.add.at(total, (lang[own], bucket[own]), n[own])
        np.add.at(letters, bucket[~own], n[~own])
    alphabet = _codes(_LATIN)
    p = letters[alphabet] + max(letters.sum(), 1.0) * 1e-4
    p = p / p.sum()
    n = len(alphabet)
    triples = np.stack(np.meshgrid(alphabet, alphabet, alphabet, indexing="ij"), -1).reshape(-1, 3).astype(np.uint32)
    background = np.full(BUCKETS, 1e-9)
    chance = (p[:, None, None] * p[None, :, None] * p[None, None, :]).reshape(-1)
    np.add.at(background, _hash(triples[:, 0], triples[:, 1], triples[:, 2]), chance)
    model = np.log(total / total.sum(axis=1, keepdims=True))
    return np.ascontiguousarray(np.vstack([model, np.log(background / background.sum()) + OTHER_BONUS]).T.astype(np.float32))


def fit(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = SAMPLE_PER_LABEL) -> np.ndarray:
    """The letter models, fitted on a bounded sample of labelled documents."""
    labelled = documents.select(F.col(doc_id).alias("doc_id"), label_language(F.col(label)).alias("declared"), F.col(text).alias("text")).where(F.col("declared").isNotNull())
    sizes = {r["declared"]: r["n"] for r in labelled.groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    if not sizes:
        return letter_model(None)
    share = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, min(1.0, per_label / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000.0
    return letter_model(sample_counts(labelled.where(draw < F.try_element_at(share, "declared")).select("declared", "text")))


def host_priors(documents: DataFrame, source: str = "source", label: str = "lang") -> tuple[DataFrame, list[float]]:
    """Smoothed shares of declared languages: per source ``source, prior``, and of all documents."""
    declared = label_language(F.col(label))
    counted = documents.select(F.col(source).alias("source"), declared.alias("c")).where(F.col("c").isNotNull()).groupBy("source", "c").agg(F.count(F.lit(1)).alias("n"))
    counted = cut(counted)  # a row per source and language, read four times below
    suffix = F.coalesce(F.regexp_extract("source", r"([^.-]*)$", 1), F.lit(""))
    per = counted.groupBy("source").agg(*[F.sum(F.when(F.col("c") == c, F.col("n")).otherwise(0)).cast("double").alias(c) for c in LANGS]).withColumn("suffix", suffix)
    by_suffix = per.groupBy("suffix").agg(*[F.sum(c).alias(f"s_{c}") for c in LANGS])
    top = by_suffix.agg(*[F.coalesce(F.sum(f"s_{c}"), F.lit(0.0)).alias(c) for c in LANGS]).first()
    whole = [(top[c] + 1.0) / (sum(top) + len(LANGS)) for c in LANGS]
    s_all, n_all = sum(F.col(f"s_{c}") for c in LANGS), sum(F.col(c) for c in LANGS)
    smoothed = by_suffix.select(F.col("suffix").alias("sfx"), *[((F.col(f"s_{c}") + SMOOTHING * F.lit(w)) / (s_all + SMOOTHING)).alias(f"s_{c}") for c, w in zip(LANGS, whole)])
    n_src = per.count()
    joined = per.join(F.broadcast(smoothed) if n_src <= BROADCAST_SOURCES else smoothed, F.col("suffix") == F.col("sfx"))
    prior = F.array(*[((F.col(c) + SMOOTHING * F.col(f"s_{c}")) / (n_all + SMOOTHING)).cast("float") for c in LANGS])
    priors = joined.where(F.col("source").isNotNull()).select(F.col("source").alias("src"), prior.alias("prior"))
    return (F.broadcast(priors) if n_src <= BROADCAST_SOURCES else priors.withColumn("src_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))), whole


def scored(texts: list[str | None], declared: list[str | None], priors: list, model: np.ndarray, whole: list[float]) -> Iterator[tuple[list[tuple], np.ndarray]]:
    """Per text its statements (see :func:`statements`) and their posteriors over ``ALL``, one row each.

    A text without statements has one row, that of its prior. Texts are taken together up to ``_CHUNK`` characters.
    """
    k = len(ALL)
    wrong = (1 - TRUST) / (k - 1)
    trusted = {c: np.log(np.where(np.arange(k) == i, TRUST, wrong)) for i, c in enumerate(LANGS)}

    def softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    at = 0
    while at < len(texts):
        docs, size, first = [], 0, at
        while at < len(texts) and (not docs or size < _CHUNK):
            docs.append(statements(texts[at]))
            size += len(texts[at] or "")
            at += 1
        shares = np.array([whole if priors[j] is None else priors[j] for j in range(first, at)], float)
        base = np.log(np.hstack([np.maximum(shares, 1e-9), np.full((len(docs), 1), OTHER_PRIOR)]))
        for j in range(len(docs)):
            if declared[first + j] in trusted:
                base[j] += trusted[declared[first + j]]
        flat = [s for d in docs for s in d]
        x = np.zeros((0, k))
        if flat:
            plains = [" " + s[2] + " " for s in flat]
            starts = np.concatenate([[0], np.cumsum([len(p) for p in plains])[:-1]])
            x = np.add.reduceat(model[_buckets(_codes("".join(plains) + "  "))], starts, axis=0, dtype=np.float64) / TEMPER
            rows = [[_ROW[w] for w in s[2].split() if w in _ROW] for s in flat]
            hits = np.zeros_like(x)
            np.add.at(hits, np.repeat(np.arange(len(rows)), [len(r) for r in rows]), _HAS[[i for r in rows for i in r]])
            n_words, han, foreign, length = (np.array(v) for v in zip(*[(s[3], s[4], s[5], len(s[2])) for s in flat]))
            evidence = hits * np.log(OWN_WORDS / STRAY_WORDS) + (n_words[:, None] - hits) * np.log((1 - OWN_WORDS) / (1 - STRAY_WORDS))
            x += np.where(_LISTED, evidence, 0.0) + np.repeat(base, [len(d) for d in docs], axis=0)
            n = 0
            for j, d in enumerate(docs):
                marks, langs = declared_elements(texts[first + j] or "")
                if len(marks) > 1:
                    for i, s in enumerate(d, n):
                        here = langs[bisect_right(marks, (s[0] + s[1]) // 2) - 1]
                        if here in trusted:
                            x[i] += trusted[here]
                n += len(d)
            strange = (foreign > 2) & (2 * foreign > length - n_words)  # more than half of the letters, or kana beside Han
            chinese = ~strange & (han >= MIN_HAN) & (han > 2 * n_words)
            x[:, ZH] -= np.where(n_words > 0, np.where(han > 0, 60.0, 1e6), 0.0)
            for at_, lang in ((strange, NONE), (chinese, ZH)):
                x[at_] = -60.0
                x[at_, lang] = 0.0
            x = softmax(x)
        alone, n = softmax(base), 0
        for j, d in enumerate(docs):
            yield d, x[n : n + len(d)] if d else alone[j : j + 1]
            n += len(d)


def posteriors(texts: list[str | None], declared: list[str | None], priors: list, model: np.ndarray, whole: list[float]) -> Iterator[list[tuple[int, int, int, int, np.ndarray]]]:
    """Per text its statements as ``start, end, words, Han letters, posterior`` over ``ALL``."""
    for d, p in scored(texts, declared, priors, model, whole):
        yield [(s[0], s[1], s[3], s[4], q) for s, q in zip(d or [(0, 0, "", 0, 0, 0)], p)]


SEGMENTS = "doc_id long, label string, declared string, segment_no int, start int, end int, lang string, confidence double, present boolean"


def segment_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", source: str = "source", per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """One row per segment of every document: ``doc_id, label, declared, segment_no, start, end, lang, confidence, present``.

    ``start`` and ``end`` count characters of the text; segments follow each other without gaps from its start to its
    end, blanks going to the segment before them. ``present`` marks segments that show their language by a whole
    statement. A text without statements has one empty segment with the language of its prior.
    """
    priors, whole = host_priors(documents, source, label)
    held = documents.sparkSession.sparkContext.broadcast(fit(documents, doc_id, text, label, per_label))
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).alias("label"), label_language(F.col(label)).alias("declared"), F.col(source).alias("src"), F.col(text).alias("text"))
    if "src_salt" in priors.columns:
        joined = docs.withColumn("src_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(priors, ["src", "src_salt"], "left")
    else:
        joined = docs.join(priors, "src", "left")

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for b in batches:
            ids, labels, decs, texts = b["doc_id"].tolist(), b["label"].tolist(), b["declared"].tolist(), b["text"].tolist()
            rows = []
            for i, (parts, p) in enumerate(scored(texts, decs, b["prior"].tolist(), held.value, whole)):
                no, run_ = 0, None
                d = None if ids[i] is None or ids[i] != ids[i] else int(ids[i])
                best = p.argmax(axis=1)
                for (start, end, _, words, han, _), k, sure, q in zip(parts or [(0, 0, "", 0, 0, 0)], best.tolist(), p[np.arange(len(p)), best].tolist(), p):
                    full = sure >= SURE and (han >= MIN_HAN if k == ZH else words >= MIN_WORDS)
                    weight = max(end - start, 1)
                    if run_ and (run_[2] == k or not (full or words >= MIN_WORDS)):
                        run_[1], run_[3], run_[4], run_[5] = end, run_[3] + weight * (sure if run_[2] == k else float(q[run_[2]])), run_[4] + weight, run_[5] or (full and run_[2] == k)
                    else:
                        if run_:
                            rows.append((d, labels[i], decs[i], no, run_[0], run_[1], ALL[run_[2]], min(run_[3] / run_[4], 1.0), run_[5]))
                            no += 1
                        run_ = [run_[1] if run_ else 0, end, k, weight * sure, weight, full]
                rows.append((d, labels[i], decs[i], no, run_[0], max(run_[1], len(texts[i] or "")), ALL[run_[2]], min(run_[3] / run_[4], 1.0), run_[5]))
            cols = list(zip(*rows)) if rows else [()] * 9
            yield pd.DataFrame({
                "doc_id": pd.array(cols[0], dtype="Int64"), "label": pd.array(cols[1], dtype="object"), "declared": pd.array(cols[2], dtype="object"), "segment_no": pd.array(cols[3], dtype="Int32"),
                "start": pd.array(cols[4], dtype="Int32"), "end": pd.array(cols[5], dtype="Int32"), "lang": pd.array(cols[6], dtype="object"), "confidence": pd.array(cols[7], dtype="Float64"), "present": pd.array(cols[8], dtype="boolean"),
            })

    return joined.select("doc_id", "label", "declared", "text", "prior").mapInPandas(run, SEGMENTS)


def document_languages(segments: DataFrame) -> DataFrame:
    """Per ``doc_id``: the language of most of its text, its confidence and all languages present."""
    size = F.greatest(F.col("end") - F.col("start"), F.lit(1))
    per = segments.groupBy("doc_id", "label", "declared", "lang").agg(F.sum(size).alias("n"), F.sum(size * F.col("confidence")).alias("c"), F.max("present").alias("present"))
    main = F.max(F.struct("present", "n", "lang", (F.col("c") / F.col("n")).alias("confidence")))
    return per.groupBy("doc_id", "label", "declared").agg(main.alias("m"), F.array_sort(F.collect_set(F.when(F.col("present"), F.col("lang")))).alias("present")).select("doc_id", "label", "declared", F.col("m.lang").alias("lang"), F.col("m.confidence").alias("confidence"), "present")


def wrong_labels(languages: DataFrame) -> DataFrame:
    """Documents whose label is missing, wrong or not the only language: ``doc_id, true_lang`` per language present."""
    fine = (F.size("present") == 1) & F.coalesce(F.get("present", F.lit(0)) == F.col("declared"), F.lit(False))
    named = F.filter("present", lambda x: x != OTHER)
    return languages.where(~fine).select("doc_id", F.explode(named).alias("true_lang")).distinct()

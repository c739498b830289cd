"""Language identification with interpolated Kneser-Ney character models.

A text becomes a stream of lower-case letters with one space between runs of letters. For every language the
counts of its ``order``-grams are gathered over all training rows; all lower orders follow from them
(continuation counts). A model is a set of sorted key arrays, one per order, with the interpolated
probability of each known gram and the backing-off weight of each known context. A gram's key packs 16 bits
per character, so it is a hash without collisions (characters beyond 16 bits are folded).

Models with more grams than may be sent at once are split by ranges of the two characters before a gram's last:
a gram, its context and the shorter ones they end in lie in one range, so each part gives the same numbers as
the whole. Texts are scored by one part after the other.

The language with the lowest cross-entropy per character wins. A text is rejected when even that is higher
than what the training texts of that language and length show, by a margin; the limits come from all of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.session import ship_code

from .common import byte_rows, slices, written

SPACE = 32
UNKNOWN = "und"
#: Entries of the highest order, over all languages, that a model sent at once may hold (16 bytes each); beyond that it is split.
MAX_ENTRIES = 4_000_000
#: Ranges that a language's values are counted in, per round of the search for a quantile.
RANGES = 4096
#: Numbers (languages times distinct grams) held while the parts of a split model are gone through.
CELLS = 1 << 23
#: Distinct grams a training task holds before it hands them on.
HELD = 2_000_000

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def streams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit characters, number of the text) of the letter streams of all texts, one after the other."""
    lower = [(t.decode() if t else "").lower() + " " for t in texts]
    sizes = np.fromiter(map(len, lower), dtype=np.int64, count=len(lower))
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the space
    row = np.repeat(np.arange(len(texts)), sizes)
    chars = np.where(letter, (codes ^ (codes >> 16)) & 0xFFFF, SPACE)
    return chars[keep].astype(np.int64), row[keep]


def grams(chars: np.ndarray, row: np.ndarray, order: int) -> np.ndarray:
    """The key of the gram that ends at each character; before the start of a text there are spaces."""
    key = np.zeros(len(chars), dtype=np.int64)
    for back in range(order - 1, 0, -1):
        before = np.full(len(chars), SPACE, dtype=np.int64)
        same = row[back:] == row[:-back]
        before[back:][same] = chars[:-back][same]
        key = key << 16 | before
    return key << 16 | chars


def _sorted_counts(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(keys, return_inverse=True)
    return u, np.bincount(inverse, weights=n, minlength=len(u)).astype(np.int64)


class KneserNey:
    """The model of one language: per order, sorted gram keys with probabilities and sorted contexts with weights."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, alphabet: int, lower: dict | None = None, rare: dict | None = None):
        """``lower``: the shorter grams with their continuation counts, by order, and ``rare``: how many grams of each
        order count 1 and 2. Both follow from the counts, unless these are only a part of the language's."""
        self.order = order
        tables = {order: _sorted_counts(keys, counts)}
        for k in range(order - 1, 0, -1):  # continuation counts: distinct characters before the shorter gram
            shorter = tables[k + 1][0] & ((1 << 16 * k) - 1)
            tables[k] = _sorted_counts(*lower[k]) if lower else np.unique(shorter, return_counts=True)
        self.grams, self.contexts = {}, {}
        self.unseen = 1.0 / alphabet
        for k in range(1, order + 1):
            keys, n = tables[k]
            n1, n2 = rare[k] if rare else (int((n == 1).sum()), int((n == 2).sum()))
            discount = n1 / (n1 + 2 * n2) if n1 else 0.5
            context = keys >> 16 if k > 1 else np.zeros(len(keys), dtype=np.int64)
            if k == 4:  # the key of four characters fills the sign bit: the context is what remains of it
                context &= (1 << 48) - 1
            names, of = np.unique(context, return_inverse=True)
            total = np.bincount(of, weights=n)
            weight = discount * np.bincount(of) / total
            lower = self._p(keys & ((1 << 16 * (k - 1)) - 1), k - 1)
            p = np.maximum(n - discount, 0) / total[of] + weight[of] * lower
            order_ = np.argsort(keys, kind="stable")
            self.grams[k], self.contexts[k] = (keys[order_], p[order_]), (names, weight)

    def _p(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Interpolated probability of the last character of each gram of ``k`` characters."""
        p = np.full(len(keys), self.unseen)
        for j in range(1, k + 1):
            part = keys & ((1 << 16 * j) - 1) if j < 4 else keys
            context = (part >> 16) & ((1 << 16 * (j - 1)) - 1) if j > 1 else np.zeros(len(keys), dtype=np.int64)
            p = p * _find(self.contexts[j], context, 1.0)
            p = _find(self.grams[j], part, p)
        return p

    def bits(self, keys: np.ndarray) -> np.ndarray:
        return -np.log2(self._p(keys, self.order))


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, other: float | np.ndarray) -> np.ndarray:
    known, value = table
    if not len(known):
        return np.broadcast_to(other, keys.shape)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, value[at], other)


class LanguageModels:
    """The models of all languages."""

    def __init__(self, models: dict[str, KneserNey], order: int):
        self.languages, self.models, self.order = sorted(models), models, order

    def entropies(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(characters of each stream, bits per character under each language)."""
        n, total = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), len(self.languages)))
        for chars, row in _blocks(texts):
            known, at = np.unique(grams(chars, row, self.order), return_inverse=True)
            n += np.bincount(row, minlength=len(texts))
            for j, lang in enumerate(self.languages):
                total[:, j] += np.bincount(row, weights=self.models[lang].bits(known)[at], minlength=len(texts))
        return n, total / np.maximum(n, 1)[:, None]

    def predict(self, n: np.ndarray, h: np.ndarray) -> list[tuple[str, float, float | None]]:
        """(language, score, bits per character) of each text, from its ``entropies``."""
        out = []
        for size, row in zip(n.tolist(), h, strict=True):
            if not size or not len(row):
                out.append((UNKNOWN, 0.0, None))
                continue
            best = int(np.argmin(row))
            score = 1.0 / np.exp2(-min(size, 64) * (row - row[best])).sum()
            out.append((self.languages[best], float(score), float(row[best])))
        return out


def _of(values: dict[str, float], lang: str) -> F.Column:
    """A column of each language's value, null where there is none."""
    if not values:
        return F.lit(None).cast("double")
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv]), F.col(lang))


def _at_rank(seen: DataFrame, ranks: dict[str, int]) -> dict[str, float]:
    """Each language's ``z`` at a rank (from 0, ascending), exactly: the rows of ever narrower ranges are counted."""
    ends = {r.lang: (r.a, r.b) for r in seen.groupBy("lang").agg(F.min("z").alias("a"), F.max("z").alias("b")).collect()}
    found, ranks = {}, dict(ranks)
    while True:
        found.update({lang: a for lang, (a, b) in ends.items() if a == b})
        ends = {lang: e for lang, e in ends.items() if lang not in found}
        if not ends:
            return found
        low, high = (_of({lang: e[i] for lang, e in ends.items()}, "lang") for i in (0, 1))
        place = F.least(F.floor((F.col("z") - low) / (high - low) * RANGES), F.lit(RANGES - 1))
        counted = seen.where(F.col("z").between(low, high)).groupBy("lang", place.alias("range"))
        rows = counted.agg(F.count("*").alias("n"), F.min("z").alias("a"), F.max("z").alias("b")).collect()
        passed = set()
        for r in sorted(rows, key=lambda r: (r.lang, r.range)):  # (the first range holds the least, the last one the largest)
            if r.lang not in passed and ranks[r.lang] < r.n:
                ends[r.lang] = (r.a, r.b)
                passed.add(r.lang)
            elif r.lang not in passed:
                ranks[r.lang] -= r.n


def rejection_limits(seen: DataFrame, share: float, margin: float) -> dict[str, tuple[float, float]]:
    """Per language (base, spread) from all rows of ``seen`` (lang, n characters, h bits per character): a text of n
    characters may have base + spread / sqrt(n) bits. All but ``share`` of the rows lie below that, by ``margin`` bits."""
    bits = F.sum((F.col("h") * F.col("n")).cast("decimal(28,9)")).cast("double")  # (the same sum in any order)
    total = seen.groupBy("lang").agg((bits / F.sum("n")).alias("mean"), F.count("*").alias("rows")).collect()
    means = {r.lang: r["mean"] for r in total}
    z = seen.select("lang", ((F.col("h") - _of(means, "lang")) * F.sqrt(F.col("n").cast("double"))).alias("z"))
    at = {r.lang: (r["rows"] - 1) * (1 - share) for r in total}
    below = _at_rank(z, {lang: int(x) for lang, x in at.items()})
    value = _of(below, "lang")
    after = z.groupBy("lang").agg(F.count_if(F.col("z") <= value).alias("n"), F.min(F.when(F.col("z") > value, F.col("z"))).alias("next"))
    out = {}
    for r in after.collect():
        a, whole = below[r.lang], int(at[r.lang])
        b = a if r.n > whole + 1 or r["next"] is None else r["next"]
        out[r.lang] = (means[r.lang] + margin, max(0.0, a + (b - a) * (at[r.lang] - whole)))
    return out


def _place(keys: np.ndarray) -> np.ndarray:
    """Where grams lie in the ranges of a split model: by the character before the last one, then by the one before that."""
    return ((keys >> 16) & 0xFFFF) << 16 | (keys >> 32) & 0xFFFF


class SplitModels(LanguageModels):
    """Models in parts, each a broadcast of all languages' grams from ``cuts[i]`` to ``cuts[i + 1]``; one is held at a time."""

    def __init__(self, languages: list[str], parts: list, cuts: list[int], order: int):
        super().__init__(dict.fromkeys(languages), order)
        self.parts, self.cuts = parts, np.array(cuts, dtype=np.int64)

    def entropies(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        n, total = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), len(self.languages)))
        held, cells = [], 0

        def score():
            for i, part in enumerate(self.parts):
                some = [np.flatnonzero(of == i) for _, _, _, of, _ in held]
                if any(map(len, some)):
                    models = part.value
                    for (_, known, _, _, bits), x in zip(held, some, strict=True):
                        for j, lang in enumerate(self.languages):
                            bits[j, x] = models[lang].bits(known[x])
                    if getattr(part, "_path", None):  # the next use reads it again
                        part.__dict__.pop("_value", None)
            for row, _, at, _, bits in held:
                for j in range(len(self.languages)):
                    total[:, j] += np.bincount(row, weights=bits[j][at], minlength=len(texts))

        for chars, row in _blocks(texts):
            known, at = np.unique(grams(chars, row, self.order), return_inverse=True)
            n += np.bincount(row, minlength=len(texts))
            of = np.searchsorted(self.cuts, _place(known), side="right") - 1
            held.append((row, known, at, of, np.zeros((len(self.languages), len(known)))))
            cells += held[-1][4].size
            if cells > CELLS:
                score()
                held, cells = [], 0
        score()
        return n, total / np.maximum(n, 1)[:, None]


def _blocks(texts: list[bytes | None], size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Streams of all texts in blocks of about ``size`` bytes. A longer text goes in parts, cut after the last
    space of a part if there is one; each part begins like a text, so a cut loses only the context of at most
    ``order`` - 1 characters."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t or b"") > size:
            yield _numbered(texts[first:i], first)
            first, held = i, 0
        held += len(t or b"")
        if held > size:  # one long text, alone in its block
            a = 0
            while a < len(t):
                b = min(len(t), a + size)
                if b < len(t):
                    space = t.rfind(b" ", a, b)
                    b = space + 1 if space > a else b
                    while b < len(t) and t[b] & 0xC0 == 0x80:
                        b -= 1
                yield _numbered([t[a:b]], i)
                a = b
            first, held = i + 1, 0
    if first < len(texts):
        yield _numbered(texts[first:], first)


def _numbered(texts: list[bytes | None], first: int) -> tuple[np.ndarray, np.ndarray]:
    chars, row = streams(texts)
    return chars, row + first


def _counted(docs: DataFrame, order: int) -> DataFrame:
    """(lang, key, n): the grams of all rows of ``docs`` (columns lang, text), counted where the rows are, then summed."""
    if not 1 <= order <= 4:
        raise ValueError("a key holds 1 to 4 characters")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)

        def hand_on():
            for lang, parts in held.items():
                keys, n = _sorted_counts(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], names=["lang", "key", "n"])
            held.clear()

        waiting = 0
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                langs = np.array(b.column("lang").to_pylist())
                for lang in np.unique(langs).tolist():
                    some = b.filter(pa.array(langs == lang))
                    for chars, row in _blocks(byte_rows(some.column("text"))):
                        keys, n = np.unique(grams(chars, row, order), return_counts=True)
                        held[lang].append((keys, n))
                        waiting += len(keys)
                if waiting > HELD:
                    for lang, parts in held.items():
                        held[lang] = [_sorted_counts(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))]
                    waiting = sum(len(k) for parts in held.values() for k, _ in parts)
                if waiting > HELD:
                    yield from hand_on()
                    waiting = 0
        yield from hand_on()

    rows = docs.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return written(rows.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")), "grams")


def _by_language(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    table = table.select("lang", "key", "n").toArrow()
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    keys, n = table.column("key").to_numpy(), table.column("n").to_numpy()
    return {lang: (keys[langs == lang], n[langs == lang]) for lang in sorted(set(langs))}


def _whole(counted: DataFrame, order: int) -> LanguageModels:
    tables = _by_language(counted)
    alphabet = len(np.unique(np.concatenate([k & 0xFFFF for k, _ in tables.values()]))) + 1 if tables else 1
    return LanguageModels({lang: KneserNey(*t, order, alphabet) for lang, t in tables.items()}, order)


def fit(docs: DataFrame, order: int = 4, max_entries: int = MAX_ENTRIES) -> LanguageModels:
    """Models from all rows of ``docs`` (columns lang, text). Rows without a language or a letter teach nothing.

    The model goes to the driver and every task, so its size is checked: above ``max_entries`` grams it goes in
    parts of about so many, with the same numbers.
    """
    counted = _counted(docs, order)
    if counted.count() <= max_entries:
        return _whole(counted, order)
    last, before = F.expr("shiftright(key, 16) & 65535"), F.expr("shiftright(key, 32) & 65535")
    tables = {order: counted}
    for k in range(order - 1, 0, -1):
        shorter = tables[k + 1].select("lang", F.col("key").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("key"))
        tables[k] = written(shorter.groupBy("lang", "key").agg(F.count("*").alias("n")), "grams")
    rare: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
    for k, table in tables.items():
        for r in table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect():
            rare[r.lang][k] = (r.n1, r.n2)
    # at most 65,536 characters, and so many before each that has too many grams for a part
    sizes = {r.c: r.n for r in counted.groupBy(last.alias("c")).agg(F.count("*").alias("n")).collect()}
    large = [c for c, n in sizes.items() if n > max_entries]
    units = [(c << 16, n) for c, n in sizes.items() if n <= max_entries]
    if large:
        pairs = counted.where(last.isin(large)).groupBy(last.alias("c"), before.alias("b")).agg(F.count("*").alias("n"))
        units += [(r.c << 16 | r.b, r.n) for r in pairs.collect()]
    cuts, size = [0], 0
    for at, n in sorted(units):
        if size and size + n > max_entries:
            cuts.append(at)
            size = 0
        size += n
    first = _by_language(tables[1])
    alphabet = len(np.unique(np.concatenate([k for k, _ in first.values()]))) + 1
    none, parts = (np.zeros(0, dtype=np.int64),) * 2, []
    place = last * 65536 + before
    for a, b in zip(cuts, [*cuts[1:], 1 << 32], strict=True):
        some = {k: _by_language(t.where((place >= a) & (place < b))) for k, t in tables.items() if k > 2 or k == order}
        if order > 2:  # the pairs do not know the character before them
            some[2] = _by_language(tables[2].where(last.between(a >> 16, (b - 1) >> 16)))
        some[1] = first
        models = {}
        for lang in first:
            own = {k: t.get(lang, none) for k, t in some.items()}
            models[lang] = KneserNey(*own[order], order, alphabet, own, rare[lang])
        parts.append(docs.sparkSession.sparkContext.broadcast(models))
    return SplitModels(list(first), parts, cuts, order)


def identify(
    docs: DataFrame,
    training,
    order: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rejected_share: float = 0.001,
    margin_bits: float = 2.0,
    keep: bool = False,
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, bits (per character), rejected.

    ``training`` is a column saying which rows teach (null: none); of these only text and language are used, and
    a row's own language never takes part in its prediction. The limits of rejection come from all training rows, as
    the one scoring of every row finds them: its result is written first. Null texts and texts without a letter are ``und``
    with score 0, and rejected. Ties go to the first language by name. With no training row every text is
    ``und``. The score is the posterior of the language at 64 characters, or fewer in a shorter text. With
    ``keep`` the result has all columns of ``docs`` (its own names, one of which may clash, come last under
    a leading ``__``).
    """
    spark = docs.sparkSession
    ship_code(spark)
    teach = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"), training.alias("teaches"))
    teach = teach.where("teaches and lang is not null and text is not null").select("lang", "text")
    models = fit(teach, order, max_entries)
    size = (16 if isinstance(models, SplitModels) else 4) << 20
    fitted = spark.sparkContext.broadcast(models)
    names = ["lang_pred", "score", "bits", "chars", "own", "own_bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = {lang: j for j, lang in enumerate(fitted.value.languages)}
        for whole in batches:
            for b in slices(whole, "text", size):
                n, h = fitted.value.entropies(byte_rows(b.column("text")))
                got = list(zip(*fitted.value.predict(n, h), strict=True))
                at = [languages.get(x) for x in b.column("own").to_pylist()]
                own = [float(h[i, j]) if j is not None and n[i] else None for i, j in enumerate(at)]
                cols = [pa.array(c, t) for c, t in zip(got, (pa.string(), pa.float64(), pa.float64()), strict=True)]
                cols += [pa.array(n, pa.int64()), b.column("own"), pa.array(own, pa.float64())]
                rest = [b.column(i) for i in range(b.num_columns - 2)]
                yield pa.RecordBatch.from_arrays(rest + cols, names=[f"c{i}" for i in range(len(rest))] + names)

    kept = docs.columns if keep else [id_col]
    # (the own language of a training row only: of the others it is not even passed on)
    own = F.when(training, docs[lang_col].cast("string")).alias("own")
    source = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text_col].cast("string").alias("text"), own)
    ddl = ", ".join(f"c{i} {source.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(kept)))
    out = written(source.mapInArrow(run, f"{ddl}, lang_pred string, score double, bits double, chars long, own string, own_bits double"), "languages")
    seen = out.where("own_bits is not null").select(F.col("own").alias("lang"), F.col("chars").alias("n"), F.col("own_bits").alias("h"))
    limits = rejection_limits(seen, rejected_share, margin_bits)
    base, spread = (_of({lang: x[i] for lang, x in limits.items()}, "lang_pred") for i in (0, 1))
    limit = F.coalesce(base + spread / F.sqrt(F.greatest("chars", F.lit(1)).cast("double")), F.lit(float("inf")))
    out = out.withColumn("rejected", F.coalesce(F.col("bits") > limit, F.lit(True)))
    names = ["lang_pred", "score", "bits", "rejected"]
    if keep:
        return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *[F.col(n).alias(f"__{n}") for n in names])
    return out.select(F.col("c0").alias("doc_id"), *names)


def held_out(id_column, parts: int, part: int) -> F.Column:
    """Whether a row belongs to the part kept from training: by the CRC-32 of its id as text (null ids: never)."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))

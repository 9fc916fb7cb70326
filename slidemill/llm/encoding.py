"""Text decoded with the wrong character encoding: candidate decodings compared by description length."""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.session import cut_lineage

#: Least clean texts of a language, bytes of its dictionary and of the text that it is trained on, and compression level.
LEAST_TEXTS, DICTIONARY_BYTES, TRAINING_BYTES, LEVEL = 40, 65_536, 1_000_000, 6
#: Words of one piece of the training text; longer words than so many characters are counted in pieces.
PIECE_WORDS, WORD_CHARS = 40, 32
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Share of a language's texts in which a letter must occur to belong to its alphabet, and of the texts of half of the languages for another character.
LETTER_SHARE, SIGN_SHARE = 0.03, 0.004
#: Bytes by which a chain must shorten the text: for a chain that ends in UTF-8, and for one from one byte to one byte; each further step costs once more.
UTF8_COST, BYTE_COST = 0.5, 1.5
#: Bytes that describe a character that no decoding gives, beside those it takes in the compressed text, and what leaving them out costs.
RAW, LOST_COST = 6, 0.5
#: Bytes that each distinct character outside a language's alphabet adds to a description in that language.
ESCAPE = 2
#: Decodings into UTF-8 that are looked ahead at once; the search is repeated on what it finds until nothing gets shorter.
MAX_STEPS = 3
#: Longest run of characters whose decodings are remembered.
CACHED_CHARS = 64

# One-byte encodings that texts are wrongly read in, and those they were written in.
READ_AS = ["cp1252", "latin-1", "mac_roman", "cp1251", "cp850", "cp437", "cp1250", "koi8-r", "cp866", "iso8859-2"]
WRITTEN_IN = ["cp1252", "cp1251", "cp1250", "koi8-r", "iso8859-2", "cp866", "mac_roman", "cp850"]
# Three-letter language codes of the texts' languages.
LANGUAGE_CODES = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "por": "pt", "pol": "pl", "ces": "cs", "cze": "cs", "rus": "ru", "ukr": "uk", "swe": "sv"}

#: UTF-8 read in a one-byte encoding gives two or more high characters in a row.
HIGH_RUN = re.compile(r"[^\x00-\x7f]{2,}")
PIECES = re.compile(r"([ \t\r\n]+)")
#: Characters that no correct decoding gives.
IMPOSSIBLE = re.compile("[�\x80-\x84\x86-\x9f]")
CYRILLIC = re.compile("[\u0400-\u052f]")
REPAIRED = "garbled boolean, repaired string, chain string"


def language_of(code: str | None) -> str | None:
    code = (code or "").strip().lower()
    head = re.split(r"[-_]", code)[0]
    return LANGUAGE_CODES.get(head, head if len(head) == 2 else None)

_ASCII = frozenset(map(chr, range(128)))


def _byte_table(encoding: str) -> list[str]:
    """The character of each byte; a byte without one is kept as a control character, as browsers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


_TABLES = {e: _byte_table(e) for e in {*READ_AS, *WRITTEN_IN}}
_BYTE_OF = {e: {c: b for b, c in enumerate(t)} for e, t in _TABLES.items()}
#: (read as, written in) to the map from what is seen to what was meant, over the characters that change.
_PAIRS = {
    (r, w): {c: _TABLES[w][b] for c, b in _BYTE_OF[r].items() if b > 127}
    for r in READ_AS for w in WRITTEN_IN if r != w
}
_TRANSLATE = {k: str.maketrans(v) for k, v in _PAIRS.items()}


def _decodings(run: str) -> dict[str, str]:
    """What a run of high characters was, by the encoding it was read in, where its bytes are UTF-8."""
    out = {}
    for read_as in READ_AS:
        byte_of = _BYTE_OF[read_as]
        try:
            out[read_as] = bytes([byte_of[c] for c in run]).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            pass
    return out


_short_decodings = lru_cache(maxsize=100_000)(_decodings)


def _run_decodings(run: str) -> dict[str, str]:
    return _short_decodings(run) if len(run) <= CACHED_CHARS else _decodings(run)


def undo_utf8(text: str, read_as: str) -> str:
    """Every run of high characters that is UTF-8 read in ``read_as`` is decoded again; other runs stay."""
    return HIGH_RUN.sub(lambda m: _run_decodings(m[0]).get(read_as, m[0]), text)


def undo_utf8_to(text: str, read_as: str, allowed: frozenset[str]) -> str:
    """As ``undo_utf8``, but what would give a high character that is not ``allowed`` stays as it is."""

    def undo(m: re.Match) -> str:
        run, at, out = m[0], 0, []
        for c in _run_decodings(run).get(read_as, ""):
            size = len(c.encode("utf-8"))  # each byte is a character of the run
            out.append(c if c <= "\x7f" or c in allowed else run[at : at + size])
            at += size
        return "".join(out) or run

    return HIGH_RUN.sub(undo, text)


def utf8_encodings(text: str) -> list[str]:
    """The encodings in which some run of the text may have been read."""
    found = {e for run in set(HIGH_RUN.findall(text)) for e in _run_decodings(run)}
    return [e for e in READ_AS if e in found]


@dataclass
class Language:
    """A language's alphabet of high characters and its compressor."""

    name: str
    alphabet: frozenset[str]
    dictionary: bytes

    def __post_init__(self) -> None:
        latin = any(c < "\u0250" and _letter(c) for c in self.alphabet) or not any(map(_letter, self.alphabet))
        self.allowed = self.alphabet | _ASCII
        #: What a word may hold: a word of another script has no Latin letters.
        self.in_word = self.allowed if latin else frozenset(c for c in self.allowed if c > "\x7f" or not c.isalpha())
        d = zstandard.ZstdCompressionDict(self.dictionary)
        d.precompute_compress(level=LEVEL)
        self._compress = zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    def length(self, text: str) -> int:
        return len(self._compress(text.encode("utf-8", "surrogatepass"))) + ESCAPE * len(set(text) - self.allowed)

    def __getstate__(self) -> dict:
        return {"name": self.name, "alphabet": self.alphabet, "dictionary": self.dictionary}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()


def clean_sample(text: str) -> bool:
    """Whether a text that models are fitted on shows no sign of a wrong decoding by itself."""
    return text.isascii() or not (IMPOSSIBLE.search(text) or utf8_encodings(text))


def _letter(c: str) -> bool:
    """A letter of an alphabet, not a sign made of one such as the micro sign or an ordinal."""
    return c.isalpha() and unicodedata.normalize("NFKC", c) == c


def _script(text: str) -> str:
    """The script of most letters, by the letters' names' blocks: latin, cyrillic or other."""
    cyrillic = 0 if text.isascii() else len(CYRILLIC.findall(text))
    latin = sum(c.isalpha() and c < "\u0250" for c in text) if cyrillic else 0
    return "latin" if latin >= cyrillic else "cyrillic"


def note_characters(counts: Counter[tuple[str, str, str]], code: str | None, text: str | None) -> None:
    """Counts a clean text by language and script, under the character ``""``, and by each high character that it holds."""
    if text and (name := language_of(code)) and clean_sample(text):
        script = _script(text)
        counts[name, script, ""] += 1
        if not text.isascii():
            counts.update((name, script, c) for c in set(text) if c > "\x7f")


def alphabets(counts: Mapping[tuple[str, str, str], int]) -> dict[str, tuple[str, frozenset[str]]]:
    """The script of most of its texts and the alphabet of every language with enough clean texts."""
    sizes: dict[str, dict[str, int]] = {}
    seen: dict[tuple[str, str], dict[str, int]] = {}
    for (name, script, c), n in counts.items():
        if c:
            seen.setdefault((name, script), {})[c] = n
        else:
            sizes.setdefault(name, {})[script] = n
    scripts = {name: max(of, key=lambda s: (of[s], s)) for name, of in sizes.items() if sum(of.values()) >= LEAST_TEXTS}
    letters: dict[str, set[str]] = {}
    signs: Counter[str] = Counter()
    for name, script in scripts.items():
        found, n_texts = seen.get((name, script), {}), sizes[name][script]
        own = {c for c, n in found.items() if _letter(c) and n >= max(2, LETTER_SHARE * n_texts)}
        letters[name] = {v for c in own for v in (c, c.upper(), c.lower()) if len(v) == 1}
        signs.update(c for c, n in found.items() if not _letter(c) and n >= max(2, SIGN_SHARE * n_texts))
    common = {"\xa0", *(c for c, n in signs.items() if 2 * n >= len(scripts))}
    return {name: (scripts[name], frozenset(letters[name] | common)) for name in sorted(scripts)}


def note_words(counts: dict[str, Counter[str]], known: Mapping[str, tuple[str, frozenset[str]]], code: str | None, text: str | None) -> None:
    """Counts the words of a clean text in its language's script and alphabet."""
    if not text or (name := language_of(code)) not in known:
        return
    script, alphabet = known[name]
    if all(c <= "\x7f" or c in alphabet for c in set(text)) and _script(text) == script and clean_sample(text):
        counts.setdefault(name, Counter()).update(_words(text))


def _words(text: str) -> list[str]:
    words = text.split()
    if len(max(words, key=len, default="")) > WORD_CHARS:
        step = WORD_CHARS // 4
        words = [w[k : k + step] if len(w) > WORD_CHARS else w for w in words for k in (range(0, len(w), step) if len(w) > WORD_CHARS else (0,))]
    return words


def train_dictionary(words: Mapping[str, int], share: float) -> bytes:
    """A compression dictionary trained on a text that holds every word ``share`` times its count, in a fixed order."""
    drawn = [w for w in sorted(words) for _ in range(int(words[w] * share + 0.5))]
    random.Random(len(drawn)).shuffle(drawn)
    data = [" ".join(drawn[k : k + PIECE_WORDS]).encode() for k in range(0, len(drawn), PIECE_WORDS)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, data, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(data)[-DICTIONARY_BYTES:]


def train(samples: Iterable[tuple[str | None, str]]) -> list[Language]:
    """One model per language with enough clean texts; ``fitted_models`` gives the same of a table.

    Texts that show a wrong decoding by themselves, in another script than most texts of their
    language, or with letters outside its alphabet are not learned from.
    """
    texts = list(samples)
    characters: Counter[tuple[str, str, str]] = Counter()
    words: dict[str, Counter[str]] = {}
    for code, text in texts:
        note_characters(characters, code, text)
    known = alphabets(characters)
    for code, text in texts:
        note_words(words, known, code, text)
    out = []
    for name, (_, alphabet) in known.items():
        found = words.get(name, {})
        total = sum(n * (len(w.encode()) + 1) for w, n in found.items())
        out.append(Language(name, alphabet, train_dictionary(found, min(1.0, TRAINING_BYTES / max(total, 1)))))
    return out


class Repairer:
    """Chooses for a text the chain of decodings with the least description length."""

    def __init__(self, languages: list[Language]):
        self.languages = languages
        self.by_name = {x.name: x for x in languages}
        self.regular = frozenset().union(*(x.alphabet for x in languages))

    def length(self, text: str) -> int:
        return min((x.length(text) for x in self.languages), default=len(text.encode("utf-8", "surrogatepass")))

    def _language(self, text: str) -> Language | None:
        return min(self.languages, key=lambda x: x.length(text), default=None)

    def _utf8_chains(self, text: str) -> Iterator[tuple[str, str, float]]:
        front, seen = [(text, "", 0.0)], {text}
        allowed, before = self.regular | set(text), None
        for _ in range(MAX_STEPS):
            step = []
            for t, chain, cost in front:
                for e in utf8_encodings(t):
                    new = undo_utf8(t, e)
                    if new not in seen:
                        seen.add(new)
                        now = (f"{chain}>{e}:utf-8".lstrip(">"), cost + UTF8_COST)
                        step.append((new, *now))
                        if not self.regular or all(c <= "\x7f" or c in allowed for c in new):
                            yield step[-1]
                            continue
                        # a character outside all alphabets, as an emoji, is believed only where the other
                        # characters alone make the text shorter; accidental runs of a clean text do not
                        part = undo_utf8_to(t, e, allowed)
                        if part == t or not all(c <= "\x7f" or c in allowed or c in t for c in part):
                            continue
                        before = self.length(text) if before is None else before
                        if self.length(part) + now[1] < before:
                            yield step[-1]
            front = step

    def _byte_chains(self, text: str, high: set[str], language: Language) -> Iterator[tuple[str, str, float]]:
        odd = high - language.alphabet
        if not odd:
            return
        parts = PIECES.split(text)
        words = [(k, w, bool(odd & set(w))) for k, w in enumerate(parts) if not w.isascii()]
        for (read_as, written), change in _PAIRS.items():
            useful = {c for c in odd if (new := change.get(c, c)) != c and new in language.allowed}
            if not useful or len(useful) * 2 < len(odd & change.keys()):
                continue
            table = _TRANSLATE[read_as, written]
            narrow, wide = list(parts), list(parts)
            for k, word, is_odd in words:
                new = word.translate(table)
                if new != word and language.in_word.issuperset(new):
                    wide[k] = new
                    if is_odd:
                        narrow[k] = new
            for variant in {"".join(narrow), "".join(wide)} - {text}:
                yield variant, f"{read_as}:{written}", BYTE_COST

    def repair(self, text: str | None, code: str | None) -> tuple[bool, str | None, str | None]:
        """(garbled, repaired text, chain); the text is unchanged and the chain null where no chain is shorter.

        Characters that no correct decoding gives are lost for good; a text is garbled by them
        too if it is shorter without them.
        """
        chains, now = [], text
        while now and not now.isascii():
            better = self._better(now, code, bytewise=not chains)
            if better is None:
                break
            now = better[0]
            chains.append(better[1])
        lost = False
        if now and (found := IMPOSSIBLE.findall(now)):
            lost = self.length(IMPOSSIBLE.sub("", now)) + LOST_COST < self.length(now) + RAW * len(found)
        return bool(chains) or lost, now, ">".join(chains) or None

    def _better(self, text: str, code: str | None, bytewise: bool) -> tuple[str, str] | None:
        """The text of the shortest description and its chain, if it is shorter than the text as it is.

        ``bytewise`` also tries chains from one byte to one byte, which only an untouched text needs.
        """
        high = {c for c in text if c > "\x7f"}
        stated = self.by_name.get(language_of(code) or "")
        candidates = [(t, chain, cost, None) for t, chain, cost in self._utf8_chains(text)]
        if bytewise and (stated is None or high - stated.alphabet):
            stated = self._language(text)
        if bytewise and (stated is None or high - stated.alphabet):
            for language in self.languages:
                candidates += [(t, chain, cost, language) for t, chain, cost in self._byte_chains(text, high, language)]
        if not candidates:
            return None
        best = (self.length(text), text, None)
        for t, chain, cost, language in candidates:
            size = (self.length(t) if language is None else language.length(t)) + cost
            if size < best[0]:
                best = (size, t, chain)
        return None if best[2] is None else best[1:]


def fitted_models(df: DataFrame, text: str = "text", lang: str = "lang") -> list[Language]:
    """The models that ``train`` gives of all rows, whatever their length, order and partitioning.

    Two passes count over the whole table: the texts of every language by script and high
    character, which give the alphabets, then the words of the texts within them. A language's
    dictionary is trained on a text that holds its words in proportion to these counts; words
    that would stand in it less than half a time are left out. Alphabets and dictionaries alone
    reach the driver. No rows and nulls give no models.
    """
    texts = df.select(F.col(lang).cast("string"), F.col(text).cast("string"))

    def characters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str, str]] = Counter()
        for b in batches:
            for code, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                note_characters(counts, code, t)
        if counts:
            names, scripts, chars = zip(*counts)
            yield pa.RecordBatch.from_pydict({"name": names, "script": scripts, "c": chars, "n": pa.array(list(counts.values()), pa.int64())})

    counted = texts.mapInArrow(characters, "name string, script string, c string, n bigint").groupBy("name", "script", "c").agg(F.sum("n").alias("n"))
    known = alphabets({(r.name, r.script, r.c): r.n for r in counted.where("n > 1 OR c = ''").collect()})
    shared = df.sparkSession.sparkContext.broadcast(known)

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[str]] = {}

        def batch() -> pa.RecordBatch:
            rows = [(name, w, n) for name, of in counts.items() for w, n in of.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], names=["name", "word", "n"])

        for b in batches:
            for code, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                note_words(counts, shared.value, code, t)
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield batch()
        if any(counts.values()):
            yield batch()

    found = texts.mapInArrow(words, "name string, word string, n bigint").groupBy("name", "word").agg(F.sum("n").alias("n"))
    found = cut_lineage(found)
    share = F.least(F.lit(1.0), F.lit(float(TRAINING_BYTES)) / F.sum(F.col("n") * (F.octet_length("word") + 1)))
    kept = found.join(F.broadcast(found.groupBy("name").agg(share.alias("share"))), "name").where("n * share >= 0.5")

    def dictionary(rows):  # type: ignore[no-untyped-def]
        import pandas as pd

        trained = train_dictionary(dict(zip(rows["word"], rows["n"])), rows["share"].iloc[0])
        return pd.DataFrame({"name": [rows["name"].iloc[0]], "dictionary": [trained]})

    trained = {r.name: bytes(r.dictionary) for r in kept.groupBy("name").applyInPandas(dictionary, "name string, dictionary binary").collect()}
    return [Language(name, alphabet, trained.get(name, b"")) for name, (_, alphabet) in known.items()]


#: The name of earlier releases, whose models were fitted on a sample.
sampled_models = fitted_models


def repair_text(df: DataFrame, models: list[Language], text: str, lang: str, out: str = "repair") -> DataFrame:
    """Adds the struct ``out`` of ``garbled, repaired, chain``.

    For every text with other than ASCII characters, candidate decodings are made: runs of
    high characters that are UTF-8 read in some one-byte encoding, any number of times, and,
    where the text holds characters outside the alphabet of its stated language and of the one
    that describes it best, words read in one one-byte encoding and written in another. Every candidate is
    compressed with the languages' zstandard dictionaries; the one of minimum description
    length, chain cost included, is taken, and the text is left unchanged if none is shorter.
    Replacement and control characters, which nothing restores, garble a text that is shorter without them.

    Whole texts are compared whatever their length. Null, empty and ASCII texts are not garbled
    and stay; an unknown language is tried with all models; repeated rows are alike; without
    models byte lengths decide. All columns are kept; ``out`` must be a new name.
    """
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    shared = df.sparkSession.sparkContext.broadcast(models)
    state: dict[str, Repairer] = {}

    @F.pandas_udf(REPAIRED)
    def fix(texts, langs):  # type: ignore[no-untyped-def]
        import pandas as pd

        repairer = state.setdefault("r", Repairer(shared.value))
        return pd.DataFrame([repairer.repair(t, c) for t, c in zip(texts, langs)], columns=["garbled", "repaired", "chain"])

    return df.withColumn(out, fix(F.col(text).cast("string"), F.col(lang).cast("string")))


def garbled_documents(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(key, garbled, repaired, chain)`` of every garbled row, by ``repair_text``'s rules, with models fitted on the whole table."""
    models = fitted_models(df, text, lang)
    shared = df.sparkSession.sparkContext.broadcast(models)
    kind = df.schema[key].dataType.simpleString()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(shared.value)
        for b in batches:
            found = [(k, t) for k, c, x in zip(*(c.to_pylist() for c in b.columns)) if (t := repairer.repair(x, c))[0]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in found], b.column(0).type),
                    pa.array([True] * len(found), pa.bool_()),
                    pa.array([t[1] for _, t in found], pa.string()),
                    pa.array([t[2] for _, t in found], pa.string()),
                ],
                names=[key, "garbled", "repaired", "chain"],
            )

    # a text of ASCII characters alone reads the same in every encoding
    high = df.where(F.col(text).rlike(r"[^\x00-\x7F]"))
    return high.select(key, lang, text).mapInArrow(search, f"`{key}` {kind}, garbled boolean, repaired string, chain string")

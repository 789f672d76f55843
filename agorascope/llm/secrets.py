"""Secret scans: fixed patterns, and spans that character Markov models find.

Two second-order models over characters, one of random strings and one of ordinary words, names and
paths, are trained from labelled samples. A run of characters is a span of kind ``markov`` if its
log-likelihood ratio a character passes the threshold that a validation part gave for strings of its
make and length.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import bounded_batches, map_batches, named

#: The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

#: What the models look at: runs of these characters, and the pieces between separators. Fewer different characters are no random string.
LEAST, LEAST_CHARACTERS = 12, 6
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
PIECE = re.compile(r"[A-Za-z0-9]+")
#: So many pieces of a run are weighed against each other; longer runs are taken part by part.
TOGETHER = 128
#: Random by make, but a name and no secret.
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")

#: Ordinary words of several languages, without accents, for the labelled samples.
WORDS_OF = {
    "de": "strasse versicherung gesellschaft wirtschaft verantwortung entwicklung geschwindigkeit bundesland rechnung schluessel wissenschaft freundschaft zeitung beispiel durchfuehrung sprachen nachricht kuenstler haushalt ueberraschung",
    "fr": "bonjour entreprise developpement gouvernement quelquefois bibliotheque connaissance heureusement maintenant environnement ville voyage ecriture personnage toujours beaucoup histoire semaine voiture nouveaux heureux oiseaux cheveux journaux lieux veux eaux",
    "es": "ayuntamiento desarrollo conocimiento universidad trabajador empresas siguiente mientras ciudadanos naturaleza pregunta escritura lenguaje aunque nosotros siempre corazon izquierda muchacho verdad",
    "it": "amministrazione cittadinanza sviluppo conoscenza giustizia passeggiata scrittura attraverso domenica famiglia ragazzi spettacolo piuttosto chiunque settimana lavoratori bellezza occhiali cucina straniero",
    "pt": "desenvolvimento conhecimento trabalhadores governo natureza escritura primeiro coracao melhor brinquedo lembranca janeiro cachorro vizinhos historia amanhecer qualquer enquanto fazenda guardanapo",
    "nl": "verzekering maatschappij ontwikkeling gemeente wetenschap vriendschap geschiedenis bijvoorbeeld schrijver morgen nieuwsbrief huishouden vergadering zaterdag kinderen vrouwelijk tuinhek voetbal rijksmuseum oorzaak",
    "pl": "przedsiebiorstwo wielobranzowe krzysztof szczegolnie wiadomosc zapytanie dziewczyna przyjaciel wrzesien rzeczpospolita gospodarka uczniowie wszystko miasto ksiazka szkola przeszlosc zwierzeta niedziela wczoraj",
    "cs": "spolecnost zprostredkovani skutecnost mesto pritel ctvrtek vzdelavani prazdniny hospodarstvi knihovna nejvetsi zivotopis rozhodnuti vysledek ctenar mluvnice krestni prohlidka zamestnanec strednik",
    "sv": "utveckling samhalle forsakring kunskap vetenskap skrivbord manniska fredag landskap bibliotek uppgift arbetare hjartligt kommunstyrelse stockholm ovriga barnvagn sjukhus nyckel fonster",
    "fi": "yhteiskunta kehitys vakuutus tietokone kirjasto ihminen perjantai maisema kaupunki tehtava tyontekija sydamellinen kunnanhallitus helsinki lastenvaunut sairaala avain ikkuna kysymys ystavyys",
    "hu": "tarsadalom fejlesztes biztositas szamitogep konyvtar emberek szombat budapest feladat munkas szivelyes onkormanyzat gyermekek korhaz kulcs ablak kerdes baratsag egeszseg megbeszeles",
    "tr": "toplum gelistirme sigorta bilgisayar kutuphane insanlar cumartesi istanbul gorev calisanlar belediye cocuklar hastane anahtar pencere sorular arkadaslik saglik toplanti gazeteci",
    "ro": "societate dezvoltare asigurare calculator biblioteca oameni sambata bucuresti sarcina muncitori primarie copiilor spital cheie fereastra intrebare prietenie sanatate sedinta ziarist",
    "id": "masyarakat pengembangan asuransi komputer perpustakaan manusia sabtu jakarta tugas pekerja pemerintah anak rumah kunci jendela pertanyaan persahabatan kesehatan pertemuan wartawan",
}
#: English ones, as names in programs have them.
IDENTIFIER_WORDS = (
    "account action active address amount array audit author balance batch block branch buffer build cache chapter "
    "client cluster column commit config connection content context counter create customer database default delete "
    "delta detail device document domain driver encode engine error event export factory feature field filter format "
    "forward frame function gateway global handler header history image import index inner invoice kernel language "
    "layer length limit listener location logger manager memory message method model module monitor network number "
    "object offset option order outer output package parameter parser partition payment pipeline pointer policy "
    "process product profile project query queue record region release report request resource response result "
    "return schema search section sequence server service session shipment signal source stage status storage stream "
    "string summary support system table target template thread timeout transfer update upload user value version "
    "window worker"
).split()
#: Codes of characters; 0 stands before the start and for others.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CODES = np.zeros(128, np.int64)
CODES[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
SIZE = len(ALPHABET) + 1
#: Lengths from which a threshold holds, and the kinds of strings that have thresholds of their own.
LENGTHS = (12, 14, 16, 20, 26)
MAKES = ("letters of one case", "letters and digits, or of two cases")
#: Validation strings that are ordinary and may pass, and what is added to the threshold.
MAY_PASS, MARGIN = 0.0005, 0.1


def make_of(token: str) -> int:
    letters = re.sub("[^A-Za-z]", "", token)
    return int(any(c.isdigit() for c in token) or not (letters.islower() or letters.isupper()))


@dataclass(frozen=True)
class MarkovModels:
    """``ratio[a, b, c]``: log odds of c after a and b, random strings against ordinary ones; thresholds by make and length."""

    ratio: np.ndarray
    thresholds: np.ndarray

    def scores(self, token: str) -> np.ndarray:
        """Log-likelihood ratio of each character."""
        codes = CODES[np.frombuffer(token.encode("ascii", "replace"), np.uint8)]
        before = np.concatenate(([0, 0], codes))
        return self.ratio[before[:-2], before[1:-1], codes]

    def threshold(self, token: str) -> float:
        return float(self.thresholds[make_of(token), max(0, sum(len(token) >= n for n in LENGTHS) - 1)])

    def is_random(self, token: str) -> bool:
        return len(token) >= LEAST and len(set(token)) >= LEAST_CHARACTERS and float(self.scores(token).mean()) > self.threshold(token)

    def spans(self, run: str) -> list[tuple[int, int]]:
        """Random parts of a run: of each part the neighbouring pieces that lie highest above the threshold together."""
        pieces = [(m.start(), m.end()) for m in PIECE.finditer(run)]
        out, todo = [], [pieces[k : k + TOGETHER] for k in range(0, len(pieces), TOGETHER)]
        while todo:
            pieces = todo.pop()
            if not pieces or pieces[-1][1] - pieces[0][0] < LEAST:
                continue
            part = run[pieces[0][0] : pieces[-1][1]]
            each, limit = self.scores(part), self.threshold(part)
            above = [float((each[a - pieces[0][0] : b - pieces[0][0]] - limit).sum()) if not run[a:b].isdigit() else -limit * (b - a) for a, b in pieces]
            best, first, last, total, start = 0.0, 0, 0, 0.0, 0
            for k, gain in enumerate(above):
                if total <= 0:
                    total, start = 0.0, k
                total += gain
                if total > best:
                    best, first, last = total, start, k + 1
            if first == last:
                continue
            a, b = pieces[first][0], pieces[last - 1][1]
            b += len(run[b:]) - len(run[b:].lstrip("="))  # the padding of base64
            if UUID.fullmatch(run, pieces[0][0], pieces[-1][1]):
                continue
            if self.is_random(run[a:b].rstrip("=")):
                out.append((a, b))
            elif last - first == len(pieces):
                continue
            todo += [pieces[:first], pieces[last:]]
        return sorted(out)


def random_string(rng: random.Random, lengths: tuple[int, int] = (LEAST, 64)) -> str:
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = (digits + "abcdef", lower, upper, lower + upper, lower + digits, upper + digits, lower + upper + digits, lower + upper + digits, lower + upper + digits + "+/", lower + upper + digits + "-_")
    alphabet = rng.choice(alphabets)
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths)))


def ordinary_string(rng: random.Random, words: list[str]) -> str:
    """A name, path, compound or slug of ordinary words, some with numbers, as texts and programs have them."""
    def word():
        w = rng.choice(words)
        if rng.random() < 0.4:  # another word of such sounds: the start of one and the end of another
            v = rng.choice(words)
            w = w[: rng.randint(2, len(w))] + v[rng.randint(0, max(0, len(v) - 3)) :]
        return w

    def number():
        return rng.choice((str(rng.randint(0, 99)), str(rng.randint(1990, 2030)), f"v{rng.randint(1, 9)}", f"{rng.randint(2000, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", str(rng.randint(10**6, 10**12))))

    shapes = ("_".join, "-".join, "/".join, "".join, "".join, lambda w: "".join(map(str.capitalize, w)), lambda w: w[0] + "".join(map(str.capitalize, w[1:])), lambda w: "_".join(w).upper(), lambda w: "-".join(map(str.capitalize, w)), lambda w: "/".join(map(str.capitalize, w)), lambda w: "".join(w).capitalize(), lambda w: "".join(w).upper())
    while True:
        parts = [word() for _ in range(rng.choice((1, 1, 2, 2, 3, 4, 5)))]
        made = rng.choice(shapes)(parts)
        if rng.random() < 0.35:
            made = made + rng.choice(("", "_", "-", "/")) + number() + rng.choice(("", "", "_" + word(), "-" + word()))
        if len(made) >= LEAST:
            return made


def ordinary_words(languages: list[str] | None = None) -> list[str]:
    return [w for name, line in WORDS_OF.items() if languages is None or name in languages for w in line.split()] + IDENTIFIER_WORDS


def labelled_samples(n: int = 12000, seed: int = 7, languages: list[str] | None = None) -> list[tuple[str, bool]]:
    """``n`` random strings of the usual alphabets and ``n`` ordinary ones, made from a seed."""
    rng, words = random.Random(seed), ordinary_words(languages)
    return [(random_string(rng), True) for _ in range(n)] + [(ordinary_string(rng, words), False) for _ in range(n)]


def _ratio(samples: list[tuple[str, bool]]) -> np.ndarray:
    """Log odds of second-order models whose counts lean on the first order's, and theirs on the single characters'."""
    logs = []
    for wanted in (True, False):
        three = np.zeros((SIZE, SIZE, SIZE))
        for token, label in samples:
            if label == wanted:
                codes = CODES[np.frombuffer(token.encode("ascii", "replace"), np.uint8)]
                before = np.concatenate(([0, 0], codes))
                np.add.at(three, (before[:-2], before[1:-1], codes), 1)
        two, one = three.sum(0), three.sum((0, 1)) + 1
        p = one / one.sum()
        p = (two + 20 * p) / (two.sum(1, keepdims=True) + 20)
        logs.append(np.log((three + 20 * p) / (three.sum(2, keepdims=True) + 20)))
    return (logs[0] - logs[1]).astype(np.float32)


def train(samples: list[tuple[str, bool]], validation: list[tuple[str, bool]] | None = None) -> MarkovModels:
    """The models of ``samples``, with thresholds from ``validation`` (by default strings of languages that a
    first model hasn't seen): of each make and length, what ``MAY_PASS`` of the ordinary strings pass, and ``MARGIN``."""
    names = list(WORDS_OF)
    judge = MarkovModels(_ratio(labelled_samples(seed=5, languages=names[::2])), np.zeros((len(MAKES), len(LENGTHS))))
    means: dict[tuple[int, int], list[float]] = {}
    for token, label in validation if validation is not None else labelled_samples(seed=6, languages=names[1::2]):
        if not label:
            for piece in {token, *(t for t in PIECE.findall(token) if len(t) >= LEAST)}:
                means.setdefault((make_of(piece), max(0, sum(len(piece) >= n for n in LENGTHS) - 1)), []).append(float(judge.scores(piece).mean()))
    limits = np.array([[np.quantile(means.get((k, n)) or [0.0], 1 - MAY_PASS) + MARGIN for n in range(len(LENGTHS))] for k in range(len(MAKES))])
    return MarkovModels(_ratio(samples), np.maximum(limits, MARGIN))


_DEFAULT: list[MarkovModels] = []


def default_models() -> MarkovModels:
    if not _DEFAULT:
        _DEFAULT.append(train(labelled_samples()))
    return _DEFAULT[0]


def _touching(base: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span shares a character with one of ``base``, which are in order: of those that start before its end, the furthest end."""
    starts, furthest = [s for s, _ in base], list(accumulate((e for _, e in base), max))

    def touches(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and furthest[before - 1] > start

    return touches


def spans(text: str | None, models: MarkovModels) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of one whole text in code points, sorted; method spans never touch base spans."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    runs = list(CANDIDATE.finditer(text))
    if runs:  # no longer than either pattern's least length, so nothing is missed
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        touches = _touching(sorted((s, e) for s, _, e in found))
        for m in runs:
            run = m[0]
            if not run.isdigit():
                found += [(m.start() + a, 3, m.start() + b) for a, b in models.spans(run) if not touches(m.start() + a, m.start() + b)]
    return sorted(found)


def find_secrets(docs: DataFrame, models: MarkovModels | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): every row's spans as array<struct<kind,start,end>>, end exclusive, without a shuffle.

    Null and empty texts have no spans. Repeated rows give repeated results, null ids stay, ids may be of
    any type, other columns are not read. Texts of any length are scanned whole. An empty table gives an
    empty table.
    """
    models = models or default_models()

    def setup():
        def work(texts):
            return None, {"spans": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t, models)] for t in texts]}

        return work

    kind = "array<struct<kind:string,start:int,end:int>>"
    return map_batches(docs.select(named(id).alias(id), named(text).cast("string").alias("text")), setup, [("spans", kind)])


def _listed(spans_column) -> F.Column:
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans and the list of all spans."""
    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(id, n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), n("markov").alias("n_markov"), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, models: MarkovModels | None = None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; n_chars, where present, follows the new text.

    Rows without spans stay as they are, nulls and empty texts included; no row goes, repeated rows each
    come back, an empty table stays empty. Columns may have any names.
    """
    models = models or default_models()

    @F.pandas_udf("string")
    def cleaned(texts):
        return texts.map(lambda t: t if t is None else _replaced(t, spans(t, models), mark))

    bounded_batches(docs.sparkSession)
    out = docs.withColumn(text, cleaned(named(text)))
    return out.withColumn("n_chars", F.length(named(text)).cast("long")) if "n_chars" in docs.columns else out


def _replaced(text: str, found: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for s, _, e in found:
        if e > at:
            out += [text[at : max(s, at)], mark] if s >= at else []
            at = max(at, e)
    return "".join(out) + text[at:]

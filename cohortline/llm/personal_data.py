"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Four base patterns give spans that always stand. High-recall generators propose
further, overlapping spans; boosted trees score each from its format and its
neighbours, a threshold per generator is calibrated on held-out labelled
candidates, and of overlapping survivors the best one is taken. The labelled
candidates are personal data and look-alikes of known formats, planted by a
seeded hash into contexts from the given documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.inputs import hashed_sample, texts_of
from cohortline.settings import cut_lineage

KINDS = ["email", "ip", "card", "phone"]
# The same matches as the plain patterns, leftmost first, without their backtracking:
# a run that can't begin a match is tried once, not at each of its characters.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried.
MARKS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}

#: Generators of further spans, in the order of their kinds after the base kinds.
_MONTH = (r"(?i:jan|ene|feb|f[eé]v|m[aä]r|a[pvb]r|ma[iy]|jui?[nl]|aug|ao[uû]|ago|sep|o[ck]t|nov|d[eéi][cz])"
          r"\p{L}{0,7}\.?")
_YEAR = r"(?:19|20)[0-9]{2}"
_AT, _DOT = "(?:at|arobase|arroba)", "(?:dot|point|punto|punkt)"
GENERATORS = {
    "phone_local": r"(?<![0-9+])(?:\(?[0-9]{3}(?:\)[\x20.-]?|[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"
                   r"|0[1-9](?:[\x20.-]?[0-9]{2}){4}"
                   r"|[6-9][0-9]{2}(?:(?:[\x20.-][0-9]{3}){2}|(?:[\x20.-][0-9]{2}){3})"
                   r"|\(?0[0-9]{1,4}\)?[\x20/.-]{1,3}[0-9]{3,8}(?:[\x20-][0-9]{2,4}){0,2})(?![0-9])",
    "mail_words": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+"
                  rf"(?:\x20?[\[({{]\x20?{_AT}\x20?[\])}}]\x20?|\x20{_AT}\x20)[A-Za-z0-9-]{{1,63}}+"
                  rf"(?:(?:\x20?[\[({{]\x20?{_DOT}\x20?[\])}}]\x20?|\x20{_DOT}\x20|\.)[A-Za-z0-9-]{{1,63}}+){{1,3}}",
    "national_id": r"(?<![0-9-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9-])",
    # groups of any length; each end of a group is a candidate's end (``_prefixes``)
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "birth_date": rf"(?<![0-9./-])(?:[0-3]?[0-9][./-][0-3]?[0-9][./-]{_YEAR}"
                  rf"|{_YEAR}[./-][01]?[0-9][./-][0-3]?[0-9]"
                  rf"|[0-3]?[0-9](?:st|nd|rd|th|er|\.|º)?\x20(?:de\x20)?{_MONTH}\x20(?:del?\x20)?{_YEAR}"
                  rf"|(?<!\p{{L}}){_MONTH}\x20[0-3]?[0-9](?:st|nd|rd|th)?,?\x20{_YEAR}"
                  r"|[0-3][0-9][./-][0-3][0-9][./-][0-9]{2}(?![./-][0-9]))(?![0-9])",
    "document_id": r"(?<![A-Za-z0-9-])(?:[A-Z]{1,3}[0-9]{6,9}|[0-9]{2}[A-Z]{2}[0-9]{5}|[0-9]{8}-?[A-Z]"
                   r"|[CFGHJK][0-9CFGHJKLMNPRTVWXYZ]{8}|[0-9]{9})(?![A-Za-z0-9-])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
            r"|(?=[0-9A-Fa-f:]{0,39}::)(?:[0-9A-Fa-f]{1,4})?(?:::?[0-9A-Fa-f]{1,4}){1,7}(?:::)?)(?![0-9A-Za-z:])",
    "mac": r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}(?:(?::[0-9A-Fa-f]{2}){5}|(?:-[0-9A-Fa-f]{2}){5})(?![0-9A-Za-z:-])",
}
#: No generator matches more code points than this, so only such neighbours overlap.
REACH = 384
#: What a text must contain for a generator to be tried; figures for those not listed.
GENERATOR_MARKS = {
    "mail_words": rf"[\[({{]\x20?{_AT}\x20?[\])}}]|\x20{_AT}\x20[A-Za-z0-9-]+(?:\x20{_DOT}\x20|\.[A-Za-z0-9]|\x20?[\[({{])",
    "ipv6": "::|(?:[0-9A-Fa-f]{1,4}:){7}", "mac": "(?:[0-9A-Fa-f]{2}[:-]){5}",
}
ORDER = [*KINDS, *GENERATORS]
IBAN = ORDER.index("iban")

#: Most documents whose contexts carry planted candidates, code points of a context, and turns of the plants.
CONTEXTS, CONTEXT, TURNS = 1500, 400, 16
#: Parts of the plants; each part's candidates calibrate by the scores of trees that saw none of its templates.
HELD_OUT = 3
#: Least precision among held-out candidates that a threshold must reach.
PRECISION = 0.98
TREES, DEPTH, SEED = 12, 4, 17
BEFORE, AFTER = 24, 8


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Whether 14 to 19 digits pass the Luhn sum."""
    digits = _digits(match)
    n = F.length(digits)
    parts = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                                                          c.cast("int") + 1)))
    total = F.aggregate(parts, F.lit(0), lambda a, b: a + b)
    return F.when(n.between(14, 19), total % 10 == 0).otherwise(F.lit(False))


def _bytes(match: Column) -> Column:
    """Whether every dotted number is at most 255."""
    return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))


def _iban_rest(match: Column) -> Column:
    """What an account number leaves modulo 97; its check digits make it 1."""
    plain = F.regexp_replace(match, "[^0-9A-Z]", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.when(
        F.ascii(c) < 65, a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)


VALID = {"email": lambda m: F.lit(True), "ip": _bytes, "card": _luhn,
         "phone": lambda m: F.length(_digits(m)).between(10, 15)}

_SPAN = "struct<start:int,end:int,kind:int,match:string>"


def _spans(text: str, pattern: str, mark: str, kind: int, valid=None) -> Column:
    """Accepted matches of a pattern with their code point positions, as an array of ``_SPAN``.

    The pieces between matches and the matches themselves add up to positions.
    They are added up in runs of the root of their number, since an array that
    grows by one is copied each time.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    between = F.split(F.col(text), pattern, -1)
    steps = F.zip_with(F.slice(between, 1, F.size(found)), found,
                       lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    none = F.array().cast(f"array<{_SPAN}>")

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + F.length(step["match"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), step["match"].alias("match"))
        accepted = F.lit(True) if valid is None else valid(step["match"])
        return F.struct(end.alias("at"), F.when(accepted, F.array_append(done["out"], span))
                        .otherwise(done["out"]).alias("out"))

    def add_run(done: Column, run: Column) -> Column:
        return F.aggregate(run, F.struct(done["at"].alias("at"), none.alias("out")), add, lambda inner: F.struct(
            inner["at"].alias("at"), F.array_append(done["out"], inner["out"]).alias("out")))

    def in_runs(steps: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(steps))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.slice(steps, i * width + 1, width))
    runs = F.flatten(F.transform(F.array(steps), in_runs))  # a lambda names the steps, so that they are found once
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
    return F.when(F.col(text).rlike(mark), F.aggregate(runs, empty, add_run, lambda done: F.flatten(done["out"]))) \
        .otherwise(none)


def base_spans(text: str) -> Column:
    """All base spans by start, then kind."""
    parts = [_spans(text, PATTERNS[k], MARKS[k], i, VALID[k]) for i, k in enumerate(KINDS)]
    plain = F.transform(F.concat(*parts), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                             s["end"].alias("end")))
    return F.array_sort(plain)


def _prefixes(spans: Column) -> Column:
    """Every span cut behind each of its groups that leaves 15 to 34 letters and digits, and whole."""
    def cut(s: Column) -> Column:
        groups = F.split(s["match"], " ")
        begun = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, 1, n), " "))
        long = F.filter(begun, lambda m: F.length(F.replace(m, F.lit(" "), F.lit(""))) >= 15)
        return F.transform(long, lambda m: F.struct(s["start"].alias("start"), (s["start"] + F.length(m)).alias("end"),
                                                    s["kind"].alias("kind"), m.alias("match")))
    return F.flatten(F.transform(spans, cut))


def candidates(text: str) -> Column:
    """What the generators propose in a text, each with its neighbourhood."""
    parts = [_spans(text, p, GENERATOR_MARKS.get(name, "[0-9]"), len(KINDS) + i)
             for i, (name, p) in enumerate(GENERATORS.items())]
    parts[IBAN - len(KINDS)] = _prefixes(parts[IBAN - len(KINDS)])
    return F.transform(F.concat(*parts), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["match"].alias("match"),
        F.substring(F.col(text), F.greatest(s["start"] - BEFORE, F.lit(0)) + 1,
                    F.least(s["start"], F.lit(BEFORE))).alias("before"),
        F.substring(F.col(text), s["end"] + 1, F.lit(AFTER)).alias("after")))


#: Words before a candidate in the languages of the documents, by what they speak for.
CUES = {name: r"(?i)(?<!\p{L})(?:" + words + ")" for name, words in {
    "call": "tel|tél|phone|call|mobile|mobil|móvil|cell|fax|ring|contact|appel|joindre|portable|handy|ruf|anruf|llam",
    "mail": "mail|write|address|reach|courriel|écri|adresse|schreib|correo|escrib",
    "person": r"(?:ssn|social|national|passport|passeport|pasaporte|insurance|id|dni|nie)\b|reisepass|ausweis|identi",
    "money": "iban|account|bank|banque|banco|transfer|pay|compte|virement|konto|überweis|cuenta",
    "birth": "born|birth|dob|né|naissance|gebor|geburt|nacid|nacim",
    "device": "mac|ipv6|ip|host|device|client|peer|gateway|appareil|gerät|equipo",
    "item": r"(?:order|invoice|version|isbn|ref|sku|part|model|no|price|total|page|build|released?|updated|dated|due)\b"
            "|commande|facture|prix|publié|bestell|rechnung|preis|seite|artikel|veröffentlicht|pedido|factura|precio|página|publicad",
}.items()}


def _features() -> dict[str, Column]:
    m, before, after = F.col("match"), F.col("before"), F.col("after")
    digits = _digits(m)
    groups = F.split(F.regexp_replace(m, "[^0-9A-Za-z]+", " "), " ")
    out = {
        "length": F.length(m), "digits": F.length(digits), "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
        "groups": F.size(groups), "longest": F.array_max(F.transform(groups, F.length)),
        "dots": F.length(F.regexp_replace(m, "[^.]", "")), "dashes": F.length(F.regexp_replace(m, "[^-]", "")),
        "brackets": F.length(F.regexp_replace(m, "[^()\\[\\]]", "")),
        "colons": F.length(F.regexp_replace(m, "[^:]", "")), "zero_first": m.rlike("^\\(?0").cast("int"),
        "spelt_dot": m.rlike(_DOT).cast("int"), "brackets_at": m.rlike(rf"[\[({{]\x20?{_AT}").cast("int"),
        "different": F.size(F.array_distinct(F.split(digits, ""))), "luhn": _luhn(m).cast("int"),
        "zeros": F.length(F.regexp_replace(digits, "[^0]", "")),
        "touches": (before.rlike("[A-Za-z0-9#/_-]$") | after.rlike("^[A-Za-z0-9/_-]")).cast("int"),
        "currency": (before.rlike("[$€£]\\s?$") | after.rlike("^\\s?(%|[$€£]|EUR|USD)")).cast("int"),
    }
    iban = F.col("kind") == IBAN
    out["account"] = F.when(iban, (_iban_rest(m) == 1).cast("int")).otherwise(0)
    # check digits that hold end a number, whatever follows
    out["goes_on"] = F.when(iban & (out["account"] == 0), after.rlike("^\\x20[A-Z0-9]{1,4}(?![A-Za-z0-9])").cast("int")).otherwise(0)
    out["year"] = F.coalesce(F.regexp_extract(m, "(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])", 0).try_cast("int"), F.lit(0))
    out |= {f"cue_{name}": before.rlike(cue).cast("int") for name, cue in CUES.items()}
    out |= {f"is_{name}": (F.col("kind") == len(KINDS) + i).cast("int") for i, name in enumerate(GENERATORS)}
    return {k: v.cast("double") for k, v in out.items()}


def with_features(df: DataFrame) -> DataFrame:
    named = _features()
    wide = df.withColumns({f"f_{k}": v for k, v in named.items()})
    return VectorAssembler(inputCols=[f"f_{k}" for k in named], outputCol="features").transform(wide) \
        .drop(*(f"f_{k}" for k in named))


def _filled(template: Column, seed: Column) -> Column:
    """A template with # for any digit, % for one from 1, x for a hexadecimal one, A for a capital and w for a small letter.

    The first KK becomes the check digits of an account number.
    """
    def drawn(letters: str, i: Column) -> Column:
        return F.substring(F.lit(letters), F.pmod(F.xxhash64(seed, i), F.lit(len(letters))).cast("int") + 1, F.lit(1))

    def fill(c: Column, i: Column) -> Column:
        return (F.when(c == "#", drawn("0123456789", i)).when(c == "%", drawn("123456789", i))
                .when(c == "x", drawn("0123456789abcdef", i)).when(c == "A", drawn("ABCDEFGHIKLMNPRSTUVXZ", i)).when(c == "w", drawn("abcdefghiklmnoprstuvwz", i))
                .otherwise(c))
    given = F.array_join(F.transform(F.split(F.replace(template, F.lit("KK"), F.lit("00")), ""), fill), "")
    check = F.lpad((98 - _iban_rest(given)).cast("string"), 2, "0")
    return F.when(template.contains("KK"), F.concat(F.substring(given, 1, 2), check, F.substring(
        given, F.lit(5), F.length(given)))).otherwise(given)


#: (label, words before, template) of planted candidates.
PLANTS = [
    (1, "call ", "(%##) %##-####"), (1, "phone: ", "%##-%##-####"), (1, "tel. ", "%##.%##.####"),
    (1, "mobile ", "%## %## ####"), (1, "", "(%##) %##-####"), (1, "fax ", "(%##) %##-####"),
    (0, "order ", "%##-%##-####"), (0, "part no ", "%##.%##.####"), (0, "ref ", "%## %## ####"),
    (0, "invoice ", "%##-%##-####"), (0, "$", "%## %## ####"), (0, "model ", "%##-%##-####"), (0, "", "%## %## ####"),
    (1, "mail ", "wwwww.www [at] wwwwww [dot] com"), (1, "", "wwwwww (at) wwwww (dot) org"),
    (1, "write to ", "www##[at]wwwwwww[dot]net"), (0, "page ", "ww [at] ww [dot] ww"),
    (1, "ssn ", "%##-##-####"), (1, "social security ", "%##-##-####"), (1, "passport id ", "%##-##-####"),
    (0, "order ", "%##-##-####"), (0, "isbn ", "%##-##-####"), (0, "sku ", "%##-##-####"), (0, "", "%##-##-####"),
    (1, "iban ", "AAKK #### #### #### ####"), (1, "account ", "AAKK##################"), (1, "bank ", "AAKK #### #### #### #### ##"),
    (0, "model ", "AA## AAAA AAAA AAAA"), (0, "ref ", "AA##A###A###A###"), (0, "version ", "AA## #### #### ####"),
    (1, "born ", "1%.0%.19##"), (1, "birth date: ", "2#/0%/19##"), (1, "dob ", "0%-1#-19##"),
    (0, "released ", "1%.0%.20##"), (0, "updated ", "2#/0%/20##"), (0, "due ", "0%-1#-20##"), (0, "", "1%.0%.20##"),
    (0, "invoice dated ", "1%.0%.19##"),
    (1, "ssn ", "%## ## ####"), (0, "order ", "%## ## ####"), (1, "call ", "(%##)%##-####"),
    (1, "mail ", "wwwww.www [at] wwww [dot] wwwwww [dot] com"),
    (1, "iban ", "AAKK##################"), (1, "account ", "AAKKAAAA##############"), (1, "", "AAKK #### #### #### #### ##"),
    (1, "transfer to ", "AAKK AAAA #### #### ##"), (1, "bank ", "AAKK###########"), (1, "", "AAKK####################"),
    (1, "pay ", "AAKK #### #### ###"), (1, "iban ", "AAKK AAAA #### #### #### #### #### ###"),
    (1, "iban ", "AAKKAAAA##########"), (0, "", "AA##################"), (0, "part no ", "AA## #### #### ###"),
    (0, "sku ", "AA##AAAA####AA##"), (0, "", "AA## #### #### #### ##"),
    (1, "born ", "19##-0%-1%"), (1, "dob ", "0%/2#/19##"), (1, "birthday ", "May 1%, 19##"), (1, "born on ", "1% March 19##"),
    (1, "date of birth: ", "19##/1#/0%"), (0, "released ", "20##-0%-1%"), (0, "updated ", "0%/2#/20##"),
    (0, "version ", "20##.0%.1%"), (0, "", "20##-0%-1%"), (0, "due ", "May 1%, 20##"), (0, "page of ", "1% March 20##"),
    (0, "invoice dated ", "19##-0%-1%"),
    (1, "téléphone ", "06 ## ## ## ##"), (1, "tél. ", "01.##.##.##.##"), (1, "appelez le ", "07########"),
    (1, "", "06 ## ## ## ##"), (1, "portable : ", "06-##-##-##-##"), (0, "commande ", "06 ## ## ## ##"),
    (0, "facture ", "03.##.##.##.##"), (0, "ref ", "0%########"), (0, "", "0%########"),
    (1, "Telefon ", "030 %#######"), (1, "Tel.: ", "0%##/%######"), (1, "rufen Sie ", "0%## %### ##"),
    (1, "Handy ", "017% %#######"), (0, "Rechnung ", "0%# %######"), (0, "Artikel ", "0%##/%######"), (0, "", "0%## %####"),
    (1, "phone ", "020 %### ####"), (1, "call ", "0%### %#####"), (1, "tel ", "(0%##) %### ####"), (0, "page ", "0%# ###"),
    (0, "model ", "0%# %### ####"), (0, "version ", "0%.####"),
    (1, "teléfono ", "6## ### ###"), (1, "móvil: ", "7## ## ## ##"), (1, "llama al ", "9## ### ###"),
    (0, "pedido ", "6## ### ###"), (0, "factura ", "9## ## ## ##"), (0, "precio ", "7##.###.###"), (0, "", "8## ### ###"),
    (0, "total ", "6##.###.###"),
    (1, "mail ", "wwwww (at) wwwwww.com"), (1, "write to ", "wwww.wwwww at wwwwww dot com"), (1, "courriel ", "wwwww (arobase) wwwwww.fr"),
    (1, "correo ", "wwwww arroba wwwwww punto es"), (1, "", "wwwww at wwwwww dot org"), (1, "", "wwwwww [at] wwwww.net"),
    (1, "", "wwww (at) wwww.com"), (1, "email ", "wwww [at] wwwww.org"), (1, "mail ", "wwww at wwww dot com"),
    (1, "", "wwwww.ww at wwwwwww dot net"), (1, "contact ", "www(at)wwwwwwww.de"), (1, "schreib an ", "wwww (at) wwwww punkt de"),
    (1, "", "ww {at} wwwwww.com"), (1, "host ", "fe80::%"), (1, "from ", "2001:db8::%"),
    (1, "compte ", "AAKK #### #### #### ###"), (1, "Konto ", "AAKK AAAA #### #### ####"), (1, "", "AAKK AAAA #### #### #### ####"),
    (1, "cuenta ", "AAKK####################"), (1, "virement ", "AAKK AAAA #### #### #### #### ###"),
    (0, "look ", "www at wwwwww.com"), (0, "", "wwwww at wwwww.www"), (0, "we were ", "wwww at wwwwwww.wwww"), (0, "see ", "ww at wwww.org"),
    (1, "né le ", "1% mars 19##"), (1, "née le ", "1er juin 19##"), (1, "geboren am ", "1%. Mai 19##"), (1, "geboren ", "1%.0%.8#"),
    (1, "nacido el ", "1% de marzo de 19##"), (1, "nacida el ", "2#/0%/7#"), (1, "date de naissance : ", "2#/0%/19##"),
    (1, "born ", "1%-0%-6#"), (0, "publié le ", "1% mars 20##"), (0, "veröffentlicht am ", "1%. Mai 20##"),
    (0, "publicado el ", "1% de junio de 20##"), (0, "Rechnung ", "1%.0%.2#"), (0, "", "2#/0%/1#"), (0, "version ", "1#.0%.2#"),
    (0, "", "1% juin 20##"),
    (1, "passport ", "A########"), (1, "passport no ", "%########"), (1, "passeport ", "##AA#####"), (1, "Reisepass ", "C%#K%#L##"),
    (1, "DNI ", "########A"), (1, "pasaporte ", "AAA######"), (1, "Ausweis ", "G%#H%#N##"), (1, "identity card ", "AA#######"),
    (0, "order ", "A########"), (0, "sku ", "AAA######"), (0, "invoice ", "%########"), (0, "part no ", "##AA#####"),
    (0, "", "%########"), (0, "model ", "AA#######"), (0, "", "AAA######"), (0, "Artikel ", "########A"), (0, "total ", "%########"),
    (1, "ip ", "fe80::x%xx:xxxx:xxxx:xxxx"), (1, "host ", "2001:db8:xxxx:xxxx:xxxx:xxxx:xxxx:xx%x"), (1, "from ", "2a01:%x::%x"),
    (1, "", "2001:%xx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx"), (1, "peer ", "fd00:xxxx:%xx::x%"), (0, "", "a::b"), (0, "use ", "fade::add"),
    (0, "ratio ", "1::%"), (0, "see ", "dead::beef::c"),
    (1, "mac ", "%x:xx:xx:xx:xx:x%"), (1, "device ", "xx-%x-xx-xx-xx-xx"), (1, "", "xx:%x:xx:xx:xx:xx"), (1, "Gerät ", "xx:xx:%x:xx:xx:xx"),
    (0, "order ", "##-##-##-##-##-##"), (0, "version ", "##-##-##-##-##-##"), (0, "total ", "##:##:##:##:##:##"), (0, "page ", "##-##-##-##-##-##"),
]


def labelled_candidates(docs: DataFrame, contexts: int = CONTEXTS) -> DataFrame:
    """(plant, label, part, candidate columns): planted candidates in words of up to ``contexts`` documents.

    The words come from a seeded place of each text. Candidates of one template
    share a part. An account number cut too early or too late is a look-alike.
    """
    beyond = F.greatest(F.length("text") - CONTEXT, F.lit(0)).cast("long")
    at = F.pmod(F.xxhash64("doc_id", F.lit("place")), beyond + 1).cast("int")
    some = hashed_sample(docs.select("doc_id", F.substring("text", at + 1, F.lit(CONTEXT)).alias("words")),
                         ["doc_id", "words"], contexts)
    plants = docs.sparkSession.createDataFrame(
        [(n, *plant) for n, plant in enumerate(PLANTS)], "n int, label int, cue string, template string")
    words = F.regexp_replace("words", "[0-9@]+", "")
    cut = F.regexp_replace(words, r"\S*$", "")
    # a document meets the plants of one turn; plants are a fixed list, so this is no join of two tables
    planted = (some.withColumn("turn", F.pmod(F.xxhash64("doc_id"), F.lit(TURNS)).cast("int"))
               .join(F.broadcast(plants.withColumn("turn", F.col("n") % TURNS)), "turn")
               .withColumn("filled", _filled(F.col("template"), F.xxhash64("doc_id", "n")))
               .withColumn("planted", F.concat(F.lit(" "), cut, F.col("cue"), F.col("filled"), F.lit(" "), words)))
    found = planted.select("n", F.xxhash64("doc_id", "n").alias("plant"), "label", "filled", F.explode(candidates("planted")).alias("c"))
    return cut_lineage(found.select("plant", "label", (F.col("n") % HELD_OUT).alias("part"),
                                    "filled", "c.*")
                       .withColumn("label", F.when(F.col("match") == F.col("filled"), F.col("label")).otherwise(0))
                       .filter((F.col("match") == F.col("filled")) | ((F.col("kind") == IBAN) & (
                           F.startswith("filled", "match") | F.startswith("match", "filled")))).drop("filled"))


@dataclass(frozen=True)
class SpanModel:
    """Boosted trees over candidate features and a least score per generator kind."""

    trees: object
    least: dict[int, float]

    def scored(self, found: DataFrame) -> DataFrame:
        return _scored(self.trees, with_features(found))

    def selected(self, found: DataFrame) -> DataFrame:
        least = F.lit(2.0)
        for kind, value in self.least.items():
            least = F.when(F.col("kind") == kind, value).otherwise(least)
        return self.scored(found).filter(F.col("score") >= least)


def _scored(trees, wide: DataFrame) -> DataFrame:
    return trees.transform(wide).withColumn("score", vector_to_array("probability")[1]) \
        .drop("features", "rawPrediction", "probability", "prediction")


def _trees(wide: DataFrame):
    """Boosted trees over labelled candidates with features; ``_Never`` if one label is missing."""
    rows = wide.select("features", F.col("label").cast("double").alias("label"))
    if rows.select("label").distinct().count() < 2:
        return _Never()
    return GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                         cacheNodeIds=False).fit(rows)


def fit_spans(labelled: DataFrame, precision: float = PRECISION) -> SpanModel:
    """Fit the trees on all labelled candidates and calibrate thresholds on templates they did not see.

    For calibration every part is scored by trees of the other parts, so a
    threshold tells the precision on formats that were never planted. Of the
    overlapping candidates of one plant the best counts, as in a text. A kind
    that reaches ``precision`` at no threshold selects nothing; so does every
    kind if one label is missing.
    """
    wide = cut_lineage(with_features(labelled).coalesce(4))  # a bounded sample
    trees = _trees(wide)
    if isinstance(trees, _Never):
        return SpanModel(trees, {})
    found: dict[int, dict[float, list[int]]] = {}
    for part in range(HELD_OUT):
        held = _scored(_trees(wide.filter(F.col("part") != part)), wide.filter(F.col("part") == part))
        best = held.groupBy("plant", "kind").agg(F.max(F.struct("score", "end", "label")).alias("best"))
        for r in best.groupBy("kind", F.round("best.score", 3).alias("score")).agg(
                F.sum("best.label").alias("good"), F.count("*").alias("n")).collect():
            counts = found.setdefault(r.kind, {}).setdefault(r.score, [0, 0])
            counts[0] += r.good
            counts[1] += r.n
    least = {}
    for kind, scores in found.items():
        good = total = 0
        for score in sorted(scores, reverse=True):
            good, total = good + scores[score][0], total + scores[score][1]
            if good and good >= precision * total:
                least[kind] = max(score - 0.0005, 0.0)
    return SpanModel(trees, least)


class _Never:
    """Stands in where there is nothing to learn from: every score is 0."""

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0), F.lit(0.0)))) \
            .withColumns({"rawPrediction": F.lit(0), "prediction": F.lit(0)})


def _named(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ORDER)), kind + 1)


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _named(s["kind"]), s["start"], s["end"])), ",")


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, base, spans) for every row of ``docs``: arrays of (start, kind, end).

    Positions are code points, ends exclusive; both arrays are ordered by start,
    then kind. ``spans`` holds every base span and what the model adds: a
    candidate at or above its kind's threshold that touches no base span and no
    better candidate. NULL and empty texts have no spans; repeated rows have the
    same spans each; a NULL doc_id stays NULL. Other columns are not read.
    """
    docs = texts_of(docs, key, text)
    model = fit_spans(labelled_candidates(docs))
    rows = cut_lineage(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), base_spans("text").alias("base"),
                                   candidates("text").alias("candidates")))
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (
        b["start"] < c["end"]) & (c["start"] < b["end"])))
    proposed = (rows.filter(F.size("candidates") > 0).dropDuplicates(["doc_id", "text_hash"])
                .select("doc_id", "text_hash", F.explode(free).alias("c")).select("doc_id", "text_hash", "c.*"))
    span = F.struct("start", "kind", "end")
    around = Window.partitionBy("doc_id", "text_hash").orderBy("start").rangeBetween(-REACH, REACH)
    scored = model.selected(proposed).withColumn("near", F.collect_list(F.struct("start", "kind", "end", "score")).over(around))
    beaten = F.exists("near", lambda o: (o["start"] < F.col("end")) & (F.col("start") < o["end"]) & (
        (o["score"] > F.col("score")) | ((o["score"] == F.col("score")) & (
            (o["start"] < F.col("start")) | ((o["start"] == F.col("start")) & (
                (o["kind"] < F.col("kind")) | ((o["kind"] == F.col("kind")) & (o["end"] > F.col("end")))))))))
    added = scored.filter(~beaten).groupBy("doc_id", "text_hash").agg(F.collect_list(span).alias("added")).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "added")
    joined = rows.drop("candidates").join(
        added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select("doc_id", "text_hash", "base", F.array_sort(F.when(
        F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans in writing."""
    spans = personal_spans(docs)
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans go together.

    n_chars, if there, becomes the new length; rows and all other columns stay.
    """
    found = (personal_spans(docs, key, text).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
             .select(F.col("doc_id").alias("_pd_id"), F.col("text_hash").alias("_pd_hash"), F.col("spans").alias("_pd_spans")))
    marked = docs.withColumns({"_pd_key": F.col(key).cast("long"),
                               "_pd_text": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    joined = marked.join(found, F.col("_pd_key").eqNullSafe(F.col("_pd_id")) & (F.col("_pd_text") == F.col("_pd_hash")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    t = F.col(text)

    def step(done: Column, span: Column) -> Column:
        piece = F.concat(done["out"], F.substring(t, done["at"] + 1, span["start"] - done["at"]),
                         F.lit("["), F.upper(_named(span["kind"])), F.lit("]"))
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"),
                        F.when(span["start"] >= done["at"], piece).otherwise(done["out"]).alias("out"))
    clean = F.aggregate("_pd_spans", start, step, lambda done: F.concat(
        done["out"], F.substring(t, done["at"] + 1, F.length(t))))
    out = joined.withColumn(text, F.when(F.col("_pd_spans").isNull(), t).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_pd_spans").isNull(), F.col("n_chars"))
                             .otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

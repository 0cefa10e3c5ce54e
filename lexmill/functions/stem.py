"""Stems of Spanish words as column expressions: suffixes are stripped within regions of the word.

The rules are those of the published Snowball description of Spanish. Regions are positions
found once in the word: RV behind its first syllable, R1 behind the first vowel and consonant,
R2 behind the next such pair.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Vowels and the suffixes of each step.
VOWELS = "aeiouáéíóúü"
PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
GERUNDS = "iéndo ándo ár ér ír ando iendo ar er ir yendo"
PLAIN = "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"
ACTIONS = "adora ador ación adoras adores aciones ante antes ancia ancias"
LOGIES, UTIONS, ENCES = "logía logías", "ución uciones", "encia encias"
QUALITIES, IVES = "idad idades", "iva ivo ivas ivos"
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
GU_VERBS = "en es éis emos"
VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré "
    "irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían "
    "aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais "
    "arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"
)
#: Words that say nothing of a sentence, as a default; callers may give others.
STOP_WORDS = tuple("a al ante como con cual cuando de del desde donde e el ella ellas ellos en entre era es esa ese eso esta este esto está están fue ha han hasta hay la las le les lo los me mi muy más ni no nos o para pero por que quien se ser si sin sobre son su sus también te tiene un una unas uno unos y ya yo".split())


def _suffix(w: Column, *lists: str) -> Column:
    """The longest of the suffixes that the word has, else the empty text: the leftmost match that reaches the end."""
    return F.regexp_extract(w, f"({'|'.join(' '.join(lists).split())})$", 1)


def _without(w: Column, suffix: Column) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - F.length(suffix))


def _dropped(w: Column, region: Column, *lists: str) -> Column:
    """The word without its longest suffix of the lists, if that lies in the region."""
    s = _suffix(w, *lists)
    return F.when((F.length(s) > 0) & (F.length(w) - F.length(s) >= region), _without(w, s)).otherwise(w)


def _pronouns(w: Column, rv: Column) -> Column:
    s = _suffix(w, PRONOUNS)

    def verb(base: Column) -> Column:
        g = _suffix(base, GERUNDS)
        good = (F.length(s) > 0) & (F.length(g) > 0) & (F.length(base) - F.length(g) >= rv) & ((g != "yendo") | base.endswith("uyendo"))
        return F.when(good, F.concat(_without(base, g), F.translate(g, "áéí", "aei"))).otherwise(w)

    return let(_without(w, s), verb)


def _standard(w: Column, r1: Column, r2: Column) -> Column:
    every = (PLAIN, ACTIONS, LOGIES, UTIONS, ENCES, "amente mente", QUALITIES, IVES)

    def rule(s: Column) -> Column:
        of = lambda words: s.isin(*words.split())
        inside = lambda region: F.length(w) - F.length(s) >= region
        rest = _without(w, s)

        def adverb(base: Column) -> Column:
            t = _suffix(base, "iv os ic ad")
            good = (F.length(t) > 0) & (F.length(base) - F.length(t) >= r2)
            return F.when(good & (t == "iv"), _dropped(_without(base, t), r2, "at")).when(good, _without(base, t)).otherwise(base)

        found = F.when(of("amente"), F.when(inside(r1), let(rest, adverb)))
        found = found.when(~inside(r2), F.lit(None))
        found = found.when(of(PLAIN), rest).when(of(ACTIONS), _dropped(rest, r2, "ic")).when(of(LOGIES), F.concat(rest, F.lit("log"))).when(of(UTIONS), F.concat(rest, F.lit("u"))).when(of(ENCES), F.concat(rest, F.lit("ente")))
        found = found.when(of("mente"), _dropped(rest, r2, "ante able ible")).when(of(QUALITIES), _dropped(rest, r2, "abil ic iv")).when(of(IVES), _dropped(rest, r2, "at"))
        return F.when(s == "", w).otherwise(F.coalesce(found, w))

    return let(_suffix(w, *every), rule)


def _verbs(w: Column, rv: Column) -> Column:
    region = F.substring(w, rv + 1, F.length(w))

    def rule(s: Column) -> Column:
        y, other = s["y"], s["other"]
        rest = _without(w, other)
        gu = F.when(other.isin(*GU_VERBS.split()) & rest.endswith("gu"), F.substring(rest, F.lit(1), F.length(rest) - 1)).otherwise(rest)
        return F.when((y != "") & _without(w, y).endswith("u"), _without(w, y)).when(other != "", gu).otherwise(w)

    return let(F.struct(_suffix(region, Y_VERBS).alias("y"), _suffix(region, GU_VERBS, VERBS).alias("other")), rule)


def _residue(w: Column, rv: Column) -> Column:
    def rule(s: Column) -> Column:
        rest = _without(w, s)
        u = s.isin("e", "é") & rest.endswith("gu") & (F.length(rest) - 1 >= rv)
        return F.when((s == "") | (F.length(rest) < rv), w).when(u, F.substring(rest, F.lit(1), F.length(rest) - 1)).otherwise(rest)

    return let(_suffix(w, "os a o á í ó e é"), rule)


def stem(word: Column) -> Column:
    """The stem of a lower-case Spanish word, without accents on vowels; null stays null."""
    v, c = f"[{VOWELS}]", f"[^{VOWELS}]"
    behind = lambda w, pattern: F.regexp_extract(w, pattern, 1)
    rv = behind(word, f"^(?:.{c}+{v}|{v}{v}+{c}|{c}{v}.)(.*)$")
    r1 = behind(word, f"^.*?{v}{c}(.*)$")
    r2 = behind(r1, f"^.*?{v}{c}(.*)$")
    at = lambda part: F.length(word) - F.length(part)

    def steps(s: Column) -> Column:
        def endings(w: Column) -> Column:
            return let(_standard(w, s["r1"], s["r2"]), lambda done: F.when(done != w, done).otherwise(_verbs(w, s["rv"])))

        return let(let(_pronouns(s["w"], s["rv"]), endings), lambda w: F.translate(_residue(w, s["rv"]), "áéíóú", "aeiou"))

    return F.when(word.isNotNull(), let(F.struct(word.alias("w"), at(rv).alias("rv"), at(r1).alias("r1"), at(r2).alias("r2")), steps))

"""Template residue and error-page text.

A response of a server stands under many addresses that have nothing to do with it. Every title and summary is masked (hosts,
numbers and codes become one sign) and all rows with the same masked field are compared: if at least `min_slugs` different
slugs on at least `min_hosts` hosts lead to it, the words of nearly all of these slugs are missing in the field, and the slugs
are unlike one another, the field is a response and not a story (by 'corpus'). Copies of a story share the words of their
slugs, and a story about such things has them in its title. Unfilled placeholders are found by detectors of their marks
('placeholder'). What the corpus does not repeat is judged by its own words ('words'): a closed vocabulary of web notices covers the
field or one of its sentences, and it names what is wrong.

Null, blank and non-text fields are no case. An address of less than three words (as /p/x7) tells nothing: its row is no
evidence, but is a case if its field is a response. Whole fields are masked and counted, of all rows, without a bound.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import spread, written

#: Names that templates give to parts of an article (fixed values of the detector).
PARTS = frozenset(
    "title headline subtitle heading summary excerpt deck standfirst teaser abstract description desc byline author name date "
    "time section topic category company product brand site page post item article issue number meta og url link image "
    "first last user email body content text lead intro slug tag tags source publisher sitename firstname lastname".split()
)
#: What tells that a mark is talked about.
TALK = re.compile(r"\s*[\"'”»`]?\s*(syntax|parameters?|fields?|escapes?|placeholders?|notation|variables?|expressions?|markers?|delimiters?|directives?)\b", re.I)
#: Names that code samples use.
DUMMY = frozenset("name var value index i j k x y n t foo bar key type id home path user".split())

#: What a placeholder cannot do without.
HINT = re.compile(r"[{\[<«%$@|]|&[a-zA-Z#]|__|XX_")
STRONG = re.compile(
    r"\{\{\{?\s*(?P<a>[A-Za-z][\w.:-]*)[^{}]{0,80}\}\}\}?"
    r"|\{%-?\s*\w+(?P<b>[^%{}]{0,60})-?%\}"
    r"|<%[=-]?\s*(?P<c>[^%<>]{1,60})%>"
    r"|\[%-?\s*(?P<d>[^%\[\]]{1,60})%\]"
    r"|[$#]\{\s*(?P<e>[A-Za-z][\w.:-]*)[^{}]{0,40}\}"
    r"|\{!\s*(?P<f>[A-Za-z][\w.:-]*)\s*!\}"
    r"|%\((?P<g>[A-Za-z][\w.:-]*)\)[sdf]"
    r"|@@(?P<h>[A-Za-z][\w.:-]*?)@@"
    r"|%%(?P<i>[A-Za-z][\w.:-]*)%%"
    r"|\[\[\s*(?P<j>[A-Za-z][\w.:-]*)\s*\]\]"
    r"|(?<!\w)__(?P<k>[A-Z][A-Z0-9_.:]*[A-Z0-9])__(?!\w)"
    r"|(?<!\w)XX_(?P<l>[A-Z0-9_.:]+)_XX(?!\w)"
    r"|<!--\s*(?P<m>[\w.:]+) goes here\s*-->"
    r"|\*\|(?P<n>[A-Z][\w:]*)\|\*"
    r"|\{(?P<o>\d)\}"
    r"|(?<![\w%])%(?P<p>s|d|\d\$[sd])(?![\w%])"
)
WEAK = re.compile(
    r"\{\s*(?P<a>[A-Za-z][\w.:-]*)\s*\}"
    r"|<(?:your\s+)?(?P<b>[A-Za-z][\w.:-]*)>"
    r"|«\s*(?P<c>[A-Za-z][\w.:-]*)\s*»"
    r"|\[(?:insert\s+|your\s+|add\s+|enter\s+)?(?P<d>[A-Za-z][\w.:-]*)(?:\s+here)?\]"
    r"|%(?P<e>[A-Z][A-Z0-9_.:]+)%"
    r"|\$(?P<f>[A-Za-z][\w.:]*)\$"
)
#: Element names of HTML, which are markup and no placeholder (fixed values).
HTML = frozenset(
    "a abbr address article aside b blockquote body br button caption center cite code col dd del details div dl dt em figcaption figure "
    "font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav noscript ol p pre q "
    "s script section small source span strong style sub summary sup svg table tbody td tfoot th thead time title tr u ul video wbr".split()
)

#: The closed vocabulary of notices, fillers and drafts in the languages of the corpus (fixed values of the detector).
LEX = frozenset(
    # English
    "a about access account accept active activate ad add after again all allow also an and any app appears are article as ask asked at available "
    "away back be because been before below best blocked blocker block blog box browser but by can cannot cards card carrying cause characters check "
    "checking clear click code come confirm connect connection contact content continue cookie cookies copy could couldn couldn't currently database day "
    "days default delete delay denied depends description detected did disable disabled display do does doesn doesn't don don't down draft dummy edit either else "
    "enable enabled end ended enter error errors establishing every example exist exists expect expected expired extension fatal feed few field file fill filler first "
    "followed following for forbidden found friday from gateway get go goes gone got has hasn have haven he headline help here home hour hours how human if in "
    "incident information insert install installed internal invalid is isn isn't issue it its javascript js jl kindly later latest launch layout least line link list load "
    "loaded loading log login longer look looking looks lorem maintenance make many max may message minimum minute minutes missing more most moved must need "
    "needed needs network new newer next no not nothing null of off offline old older on once one only open opened or order original our out over overwrite owner page "
    "pages past paste past patience permission person phone placeholder planned please post posts press problem properly prove provide publish publishing put read reader reading reason "
    "recent redirected redirecting refresh reload removed replace replaced reply reply report request requested requests require required requires resource response restricted retry "
    "return returned returning right robot robots run running running sample sample script scripting scripts seconds second secure security see seem seems sending "
    "server service session settings setup short should showing shown sign site sorry soon standfirst start started status still story subscribe sure summary support supported switch switched "
    "take takes taken teaser technical template temporarily temporary test text than thank thanks that the their them then there these they this ticking time timed title "
    "to today todo too traceback tried tries try turn turned two type typeerror uh oh oops unable unavailable uncaught undefined under unexpected unknown unless unsupported until "
    "up update updated upgrade upstream us use used using verify verifying version view viewing visit wait was we we'll we're we've web website welcome were what when "
    "which while who will window with without won won't work works working world wraps write writing wrong you your yourself headline blurb body caption intro lede lead nan none object "
    "keyerror exception line file render call last www srv index php html id made assistant purposes closes lines two reference ray region country met condition condition did answer answered"
    " another other different date dates modern instead otherwise might would like let lets sent given provided part parts full whole items find lost going being had were into through much very really never always whether neither both each per via whatever whoever center centre desk team captcha cloudflare ddos challenge human bots bot automated traffic unusual suspicious activity firewall protected origin host resolve dns timeout timed bad found visitor visitors js"
    # German
    " aktivieren aktiviert aktiviere angeforderte angezeigt angezeigte anmelden anreißer anzeigen anzuzeigen auf aus beispieltext bitte blindtext browser cookies damit das dass der des deaktiviert deaktivieren die diese diesem dieser "
    "dieses ein eine einen einer ersetzen erlauben erneut erscheint es existiert fehler fehlercode gefunden gesperrt gewartet haben hier ihr ihre ihrem ihren im in inhalt ist javascript kann kein keine können laden leider "
    "mehr melden mit müssen neu nicht noch nummer oder platzhalter später schalten seite sie sind skripte skript sitzung steht text titel um und versuchen verschoben verfügbar vorübergehend vorspann warten wartung wartungsarbeiten wegen "
    "weiter werden wird wurde zeigen zu zugriff zugelassen zulassen zum zur überschrift folgt einfügen verweigert abgelaufen benötigt erforderlich derzeit kommt gleich wieder da roboter einschalten"
    # French
    " accès activer activez actualiser à a afficher article autorisez autoriser ce cette chapeau code compléter connexion continuer cookies dans de demandée demandé demande des du déplacée déplacé désactivé désactivée désactivés "
    "en erreur est et été existe expirée expiré ici il indisponible interdit introuvable javascript la le les lire maintenance merci mot navigateur ne nous numéro ou page par pas patienter plus pour provisoire réessayer refusé remplacer "
    "requis requise recharger scripts service session seront site sur temporairement texte titre trouvée trouvé un une utilisateur veuillez venir viendra votre vous êtes robot rédiger remplissage faux"
    # Spanish
    " acceso activa active activar actualice actualizar aquí artículo caducado código con contenido continuar cookies cargar de deshabilitado desactivado denegado disponible el en encontrada encontrado encontró entradilla error es esta está este "
    "existe expirado fuera ha habilite habilitar intente irá javascript la las lo los mantenimiento mostrar más navegador no número o página para permita permitir por prueba pudo que recargue relleno requiere robot scripts se servicio sesión si "
    "siga sitio solicitada solicitado su sustituir temporalmente tiene título texto un una usted ver y ya vuelva".split()
)
#: Words that name what is wrong; a notice holds one.
WRONG = frozenset(
    "javascript js script scripts scripting skripte skript cookies cookie browser navigateur navegador blocker robot captcha denied verweigert denegado refusé unavailable unsupported supported indisponible disponible verfügbar maintenance wartung "
    "wartungsarbeiten mantenimiento expired ended abgelaufen expirée expiré caducado expirado error erreur fehler fehlercode errors found introuvable encontrada encontrado gefunden trouvée gone moved removed deleted existiert verschoben déplacée "
    "forbidden gateway database undefined null nan traceback uncaught typeerror keyerror exception permission loading blocked gesperrt region requests connection secure security placeholder dummy sample default example filler lorem ipsum todo "
    "template blindtext platzhalter provisoire relleno prueba compléter insert overwrite upgrade test asdf right back person human second moment wait assistant field headline text edit condition invalid reply answer cargar later anreißer upstream offline nothing window page".split()
)
#: Those of them that name it without doubt: one of these makes a single sentence of a longer text a notice.
PLAIN = WRONG - frozenset("page text test right back person human second moment wait assistant field headline condition reply answer later window sample template default example connection secure security request requests moved removed edit insert region upgrade offline".split())
#: Whole fields that residue leaves, as patterns over the cleaned text (fixed values).
WHOLE = re.compile(
    r"^(?:\W|\b(?:undefined|null|nan|none|nil|tbd|tba|todo|n/a|object)\b)+$"
    r"|^.{0,60}\[object \w+\]"
    r"|^(?:x{2,}[\s.,]*)+$"
    r"|^(?:(?:test|text|asdf|jkl|qwer|qwerty|foo|bar|baz|blah|bla|abc|lorem|ipsum|x+)[\s.,!?]*){2,}(?:[0-9a-f]{3,8})?\W*$|^(?:asdf|qwer|qwerty)\w*\W*$"
    r"|^\{\s*\"(?:error|errors|status|message|code|fault)\""
    r"|^(?:traceback \(most recent call last\)|fatal error:|uncaught \w*error|(?:php )?(?:warning|notice|parse error):|exception in thread)"
    r"|^(?:http(?:/[\d.]+)?\s*)?(?:error\s*)?[45]\d\d(?:\s*error)?\W*(?:$|(?:not found|forbidden|bad gateway|service|internal|too many|unauthori[sz]ed|gone|gateway|nothing to see)\b[^:]{0,60}$)"
    r"|^todo\b\s*:?\s*(?:add|write|get|paste|title|fill|insert|replace|summary|headline|text|put)\b.{0,60}$"
    r"|^(?:just a (?:second|moment)|one moment|please wait|loading|chargement|cargando|wird geladen|lädt)\W*(?:please)?\W*$"
    r"|^security check(?: - \S+)?$"
    r"|^(?:copy of )+\S.{0,40}$"
    r"|^.{0,60}\bdo not publish\b",
    re.I,
)
#: Latin filler (fixed values).
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat "
    "duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum morbi rhoncus lacus pharetra gravida sapien vitae "
    "vestibulum pellentesque mauris praesent curabitur nullam donec phasellus integer vivamus suspendisse".split()
)
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
HOST = re.compile(r"\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}\b", re.I)
TAG = re.compile(r"</?[A-Za-z][^<>]*>")
#: Ids of requests, codes and numbers.
HEX = re.compile(r"[a-f]{4,8}|\w*\d\w*")
DOTTED = re.compile(r"[a-z]\.[a-z]")
SUFFIX = re.compile(r"^(?:(?:update|updated|video|exclusive|fwd|fw|re|rfc|new post|\[[\w .]{1,12}\])\s*:?\s+)?(.*?)(?:\s+[|–—-]\s+[^|–—]{2,40})?(?:\s*\[\w{2}\])?\s*$", re.I | re.S)
AFFIX = re.compile(r"[:\[]|\s[|–—-]\s|^re ", re.I)
ADDRESS = re.compile(r"^\s*https?://([^/?#\s]+)([^?#]*)", re.I)


def placeholder(raw: str) -> bool:
    """An unfilled mark stands in raw; marks that the text talks about, as code, do not count."""
    if not HINT.search(raw):
        return False
    text = html.unescape(raw) if "&" in raw else raw
    for pattern, strong in ((STRONG, True), (WEAK, False)):
        for m in pattern.finditer(text):
            name = m.group(m.lastgroup) if m.lastgroup else ""
            parts = [p for p in re.split(r"[\s._:|'\"=-]+", name.lower()) if p]
            known = any(p in PARTS for p in parts)
            dummy = len(parts) == 1 and parts[0] in DUMMY
            told = TALK.match(text, m.end()) or "syntax" in text and dummy
            if strong and (told or dummy and re.search(r"\b(syntax|escapes?|templat|engine|parser|braces?)", text, re.I)):
                continue
            if not strong:
                if m.lastgroup == "b" and "your " not in m.group(0):
                    # an element of HTML if it came as one: written raw, in lower case, and closed or void
                    if name.lower() in HTML and (m.group(0) in raw and (f"</{name}" in raw or name.lower() in ("br", "hr", "p", "li", "img", "summary", "section") and name.islower() and f"</{name}" in raw)):
                        continue
                if m.lastgroup == "c" and not (known and (name.isupper() or "." in name or ":" in name or "_" in name or name.islower() and len(parts) == 1 and parts[0] in PARTS)):
                    continue
                if m.lastgroup == "d" and "insert" not in m.group(0) and "here" not in m.group(0) and not (name.isupper() or "." in name or "_" in name):
                    continue
                if told or not known or dummy:
                    continue
            return True
    return False


def clean(raw: str, lines: bool = False) -> str:
    """Text as a reader sees it: entities once, comments and tags away (what stands in noscript stays), white space collapsed;
    with lines, line ends stay."""
    if "&" in raw:
        raw = html.unescape(raw)
    if "<" in raw:
        raw = TAG.sub(" ", raw)
    return "\n".join(" ".join(x.split()) for x in raw.splitlines()) if lines else " ".join(raw.split())


def notice(text: str, bar: float, low: str | None = None, words: list[str] | None = None, raw: str | None = None) -> bool:
    """The whole text or one sentence of it is a notice: nearly all of its words are of LEX, one says what is wrong."""
    if WHOLE.match(text):
        return True
    if words is None:
        low = text.lower().replace("’", "'")
        words = WORD.findall(low)
    if not LATIN.isdisjoint(words) and len(words) >= 3 and sum(w in LATIN for w in words) >= 0.7 * len(words):
        return True
    if WRONG.isdisjoint(words):
        return False
    # a text of which most words are unknown is no notice, whatever its hosts and codes
    if 2 * sum(map(_known, words)) >= len(words) and _covered(low, bar):
        return True
    if PLAIN.isdisjoint(words):
        return False
    parts = SENTENCE.split(low if raw is None or "\n" not in raw else clean(raw, lines=True).lower().replace("’", "'"))
    return len(parts) > 1 and any(len(p) > 12 and p.rstrip()[-1:] in ".!?…" and _told(p) for p in parts)


def _told(sentence: str) -> bool:
    """Every word of the sentence is of LEX, at least four of them, one says what is wrong."""
    words = WORD.findall(sentence)
    if len(words) < 4 or PLAIN.isdisjoint(words):
        return False
    for w in words:
        if not _known(w) and not any(c.isdigit() for c in w):
            return "." in sentence[:-1] and _covered(sentence, 1.0)
    return True


def _known(w: str) -> bool:
    return w in LEX or "'" in w and all(p in LEX for p in w.split("'") if len(p) > 1)


def _covered(low: str, bar: float) -> bool:
    words = [w for w in WORD.findall(HOST.sub(" ", low)) if not HEX.fullmatch(w)]
    if not words or WRONG.isdisjoint(words):
        return False
    if len(words) <= 2:
        return all(map(_known, words)) and bool(SHORT.search(low))
    return sum(map(_known, words)) >= bar * len(words)


#: Notices of one or two words (fixed values); other pairs of such words are no notice.
SHORT = re.compile(
    r"^\W*(?:access denied|accès refusé|acceso denegado|zugriff verweigert|forbidden|(?:page )?not found|page introuvable|(?:service )?unavailable|session expired|error|erreur|fehler|javascript required|todo|untitled|placeholder|"
    r"blindtext|platzhalter|lorem ipsum|loading|sample (?:post|text|title)|dummy text|test (?:post|page|title)|bad gateway|server error|sitzung abgelaufen|session expirée|sesión caducada|seite gesperrt|wartungsarbeiten|under maintenance)\W*$",
    re.I,
)


class Field:
    """A title or summary as it is judged and masked."""

    def __init__(self, raw: str, title: bool = False) -> None:
        self.raw, self.text = raw, clean(raw)
        self.low = self.text.lower()
        if "’" in self.low:
            self.low = self.low.replace("’", "'")
        self.words = WORD.findall(self.low)
        # what publishers put around a title
        self.core = SUFFIX.match(self.text).group(1) or self.text if (title or not WRONG.isdisjoint(self.words)) and AFFIX.search(self.text) else self.text

    def own(self, bar: float = 0.85) -> str | None:
        """'placeholder' or 'words' where the field is a case by itself."""
        if placeholder(self.raw):
            return "placeholder"
        if notice(self.text, bar, self.low, self.words, self.raw) or self.core != self.text and notice(self.core, bar):
            return "words"
        return None

    def mask(self) -> int | None:
        """A hash of the field's words without hosts and what holds digits; None where none are left."""
        words = self.words if self.core == self.text else WORD.findall(self.core.lower())
        if DOTTED.search(self.low):
            words = WORD.findall(HOST.sub(" ", self.core.lower()))
        held = " ".join([w for w in words if w.isalpha()])
        return int.from_bytes(blake2b(held.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) if held else None

    def shares(self, slug: tuple[str, ...]) -> int:
        """How many words of the slug stand in the field, 3 for more; slugs drop accents, with or without their letters."""
        low, n = self.low, 0
        if not low.isascii():
            low = f"{low} {_plain(low)} {low.encode('ascii', 'ignore').decode()}"
        for w in set(slug):
            # a word of the field: most are not even a part of it
            if w in low and (w in self.words or re.search(rf"(?<![^\W_]){w}(?![^\W_])", low)):
                n += 1
                if n == 3:
                    break
        return n


def fields(title: str | None, summary: str | None) -> list[Field]:
    return [Field(x, i == 0) for i, x in enumerate((title, summary)) if isinstance(x, str) and x.strip()]


def judge(title: str | None, summary: str | None, bar: float = 0.85) -> str | None:
    """'placeholder', 'words' or None: what a row is by its own text."""
    return max((x for f in fields(title, summary) if (x := f.own(bar))), default=None, key=lambda x: x == "placeholder")


def _plain(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


SLUG = re.compile(r"[^\W\d_]{3,}")


def slug_of(url: str | None) -> tuple[str | None, tuple[str, ...]]:
    """The host and the words of the part of the path that has most; less than three words are none."""
    where = ADDRESS.match(url) if isinstance(url, str) else None
    if not where:
        return None, ()
    words = max((SLUG.findall(p.removesuffix(".html").lower()) for p in where.group(2).split("/")), key=len, default=[])
    return where.group(1).lower(), tuple(words) if len(words) >= 3 else ()


def _signals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for row_no, title, summary, url in zip(b["row_no"], b["title"], b["summary"], b["url"]):
            host, slug = slug_of(url)
            have = fields(title, summary)
            own = max((x for f in have if (x := f.own())), default=None, key=lambda x: x == "placeholder")
            seen = [(m, f.shares(slug)) for f in have if (m := f.mask()) is not None]
            rows.append((row_no, own, host, " ".join(slug) or None, [m for m, _ in seen], [n for _, n in seen]))
        yield pd.DataFrame(rows, columns=["row_no", "own", "host", "slug", "masks", "shared"])


def responses(parts: DataFrame, min_slugs: int, min_hosts: int, unlike: float = 0.75, alike: float = 0.5) -> DataFrame:
    """The masks (m) that are responses: parts holds m, slug, host and shared (words of the slug in the field) of every field whose
    address has words.

    Counts are exact and partially aggregated by (mask, slug), so that no task holds the rows of a frequent mask."""
    by_slug = parts.groupBy("m", "slug").agg(F.min("shared").alias("shared"))
    # a first, cheap bound: one slug is enough to leave out what only one address leads to
    some = by_slug.groupBy("m").agg(F.count("*").alias("slugs"), F.avg((F.col("shared") <= 1).cast("int")).alias("unlike"))
    some = some.where((F.col("slugs") >= min_slugs) & (F.col("unlike") >= unlike)).select("m", "slugs")
    # merge joins: how many masks are left grows with the input, so that they are never broadcast
    hosts = parts.join(some.hint("merge"), "m").select("m", "host").distinct().groupBy("m").agg(F.count("*").alias("hosts")).where(F.col("hosts") >= min_hosts)
    words = by_slug.join(some.hint("merge"), "m").select("m", "slugs", F.explode(F.array_distinct(F.split("slug", " "))).alias("w"))
    each = words.groupBy("m", "slugs", "w").agg(F.count("*").alias("n"))
    most = F.sum(F.when(F.col("n") > F.greatest(F.lit(1.0), F.col("slugs") / 2), F.col("n")).otherwise(0))
    varied = each.groupBy("m").agg((most / F.sum("n")).alias("alike")).where(F.col("alike") <= alike)
    return hosts.join(varied.hint("merge"), "m").select("m")


def residue(pool: DataFrame, min_slugs: int = 3, min_hosts: int = 2) -> DataFrame:
    """Rows of pool (row_no, title, summary, url) that hold residue: row_no, by ('corpus', 'placeholder' or 'words', the first
    that holds).

    An empty pool gives an empty result; other columns are ignored; repeated rows count once."""
    judged = spread(pool.select("row_no", "title", "summary", "url")).mapInPandas(
        _signals, "row_no bigint, own string, host string, slug string, masks array<bigint>, shared array<int>"
    )
    # written once: the counts and the rows read it
    signals = written(judged)
    field = F.explode(F.arrays_zip("masks", "shared")).alias("x")
    each = signals.select("row_no", "host", "slug", field).select("row_no", "host", "slug", F.col("x.masks").alias("m"), F.col("x.shared").alias("shared"))
    found = responses(each.where("slug is not null"), min_slugs, min_hosts)
    # a row whose own slug the field matches is a story
    corpus = each.where("shared < 3").join(found.hint("merge"), "m", "left_semi").select("row_no", F.lit("corpus").alias("by"))
    own = signals.where("own is not null").select("row_no", F.col("own").alias("by"))
    return own.unionByName(corpus).groupBy("row_no").agg(F.min("by").alias("by"))

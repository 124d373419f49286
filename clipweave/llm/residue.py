"""Template residue and error-page text: placeholders, filler, error messages, script notices."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.session import cut

#: Sources in which a message must recur, word for word after masking, for a weak phrase on a line of its own to count.
WIDE = 2
#: Words a document may have beside a weak message and still consist of it.
BESIDE = 6

# What is masked, in this order.
MASKS = (
    (re.compile(r"https?://\S+|www\.\S+"), "<url>"),
    (re.compile(r"[\w.+-]+@[\w-]+\.\w[\w.]*"), "<mail>"),
    (re.compile(r"\b\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}\b"), "<date>"),
    (re.compile(r"\b(?=[0-9a-f]*\d)[0-9a-f]{4,}\b"), "<id>"),
    (re.compile(r"\d+"), "<n>"),
)
#: A field nobody filled in. The name is a word or several, with nothing of an expression in it.
_NAME = r"[^\W\d](?:[\w \-]{0,38}\w)?"
PLACEHOLDERS = re.compile(
    rf"\{{\{{\s*{_NAME}\s*\}}\}}|\$\{{\s*{_NAME}\s*\}}|(?<![\w$]){{\s*{_NAME}\s*}}|\{{%\s*{_NAME}\s*%\}}|<%=?\s*{_NAME}\s*%>|%\({_NAME}\)[sd]"
    r"|(?<![\w%])%[^\W\d]\w{2,38}%(?!\w)|(?<!\w)__[^\W\d_]\w*?[^\W_]__(?!\w)|(?<![\w#])#[^\W\d]\w{1,38}#(?!\w)"
    rf"|\[\[\s*{_NAME}\s*\]\]|\[\s*(?:insert|enter|type|your|add)\s[^\]\n]{{1,60}}\]|[\[«]\s*(?:اكتب|ضع|أدخل|ادخل|أضف)\s[^\]»\n]{{1,60}}\sهنا\s*[\]»]"
    r"|\btodo:?\s+(?:add|fill|insert|write)\s+\w+|<(?P<tag>[^\W\d]\w{1,38})>"
)
# Names of page elements, which are no fields when they stand in angle brackets.
PAGE_TAGS = set(
    "html head body title meta link script noscript style div span p a b i u s em strong br hr img ul ol li table thead tbody tr td th form input button "
    "label select option textarea h1 h2 h3 h4 h5 h6 header footer nav main section article aside figure figcaption video audio source iframe code pre "
    "blockquote small sub sup canvas svg path details summary".split()
)
# The words of the usual filler, of keys hit at random, and of blind text.
LOREM = set(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis "
    "nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla "
    "pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
MASHED = set("foo bar baz qux qwer qwerty asdf asdfgh zxcv blah xxx test abc".split())
FILLER_RUN = 5

_JS = r"(?:java ?script|js|scripts|(?:ال)?جافا ?سكر[يبت]+|(?:ال)?سكربتات|(?:ال)?سكريبتات)"
# Sentences that only the thing itself says. Someone who writes about it words it differently.
STRONG = {
    "filler": re.compile(
        r"\b(?:sample|dummy|placeholder|filler) text\.? *(?:replace|edit|change|goes|here)|\bthis is (?:a |some )?(?:placeholder|dummy|sample|filler) (?:paragraph|text|content|sentence)\b"
        r"|\breplace this (?:text|paragraph) with\b|\btext to be (?:written|added|filled|replaced|inserted)(?: in)? (?:before|later|here)|\b(?:your|the) (?:\w+ ){1,4}?(?:will )?goe?s? here\b"
        r"|هذا (?:ال)?نص (?:ال)?(?:تجريبي|مؤقت|شكلي|بديل|هو مثال)|نص (?:تجريبي|مؤقت|بديل) هنا|(?:يكتب|يوضع|يضاف) (?:هنا|لاحقا)|مساحة فارغة (?:لل|ل)نص|(?:يستبدل|استبداله) لاحقا"
    ),
    "script": re.compile(
        rf"<noscript|\b(?:enable|activate|allow|turn on|switch on|need|requires?) {_JS} (?:to|in order to|in your browser|and cookies)\b|\b{_JS} (?:is|are|seems to be|appears to be) (?:\w+ )?(?:disabled|blocked|turned off|switched off|off|not enabled|required)\b(?: (?:in|on|by) (?:your|this)|\W*$|\. )"
        rf"|\bbrowser (?:does not|doesn't|cannot|can't|can not|did not) (?:support|run|execute) {_JS}|\bonly (?:when|with|if) {_JS} (?:is |are )?(?:turned|switched|enabled|on|allowed)"
        rf"|(?:يجب|يلزم|يرجى|برجاء|لازم) (?:تفعيل|تشغيل|تمكين) {_JS}|(?:من فضلك|رجاء|يرجى) \w{{2,6}} {_JS} (?:علشان|عشان|حتى|لكي|ل)|متصفحك (?:لا يدعم|مش بيدعم|لا يشغل|مابيدعمش) {_JS}"
    ),
    "error": re.compile(
        r"\berror \d{3}\s*[:\-–]\s*\w|\bhttp/[\d.]+ \d{3}\b|\bhttp \d{3}\b|\b(?:the|this) \w+ (?:(?:you|at|that)\b[\w ]{0,40}? )?(?:cannot|can't|could not|can not|was not|wasn't) (?:be )?(?:found|loaded)\b\W*(?:\(|$|\n)"
        r"|\b(?:failed|could not|unable|cannot) (?:to )?connect to the \w+ (?:server|database|host)|\bserver timed out\b|\b(?:fatal error|notice|warning|parse error): (?:undefined|uncaught|unexpected)\b|\btraceback \(most recent call last\)"
        r"|\[object object\]|\baccess (?:to this \w+ )?(?:is|was|has been) (?:refused|denied|blocked|forbidden)\b(?:\.|,|:)? *(?:incident|event|ray|reference|ref|id|ticket|$)|\btoo many requests(?: from your|\. (?:wait|slow|please|try))|\bthis \w+ is (?:private|no longer available|not available any ?more)\b(?:\.|$)|\byour session (?:has|is|was) (?:expired|ended|timed out|closed)"
        r"|\bsomething (?:went wrong|failed|broke) (?:on|at) our (?:side|end)\b|\b(?:this|the) \w+ is (?:down|closed|offline|unavailable) for (?:\w+ )?(?:maintenance|repairs|upgrades?)\b|\bis (?:not available|unavailable) in your (?:country|region|area)\b"
        r"|\b(?:checking|verifying) your browser before\b|\b(?:verify|confirm|prove) (?:that )?you are (?:a )?(?:human|not a robot)\b|\bservice unavailable\.? *please\b|\b\d{3} (?:internal server error|bad gateway|gateway timeout|service unavailable|too many requests)\b\W*$"
        r"|(?:التسجيل|الفيديو|المقطع|الحلقة|الصفحة|الموقع) (?:ده|دي|دا|هذا|هذه) (?:مش|غير) (?:متاحة?|شغالة?|متوفرة?) (?:دلوقتي|حاليا|الآن)"
        r"|(?:الصفحة|المقطع|الحلقة|الموقع) (?:المطلوبة?|ده|دي|هذا|هذه|(?:اللي|التي|الذي) [\w ]{1,30}) ?(?:غير موجودة?|مش موجودة?|اتشالت|لم يعد|لم تعد|غير متاحة?) ?\(|حدث (?:خطأ|عطل) غير متوقع|(?:الخادم|السيرفر|الموقع|المشغل) (?:تحت الصيانة|مشغول|متوقف|لا يستجيب)|غير (?:مسموح|مصرح) لك ب"
    ),
}
# Bare phrases that people also write about. They count only where a document consists of them, or on lines
# of their own that recur across sources.
WEAK = re.compile(
    r"\b(?:error )?\d{3}:? (?:not found|forbidden|unauthorized|bad request|gone|internal server error|bad gateway|gateway timeout|service unavailable|too many requests)\b|\berror \d{3}\b|\bpage not found\b|\baccess denied\b|\bservice unavailable\b"
    r"|\b(?:undefined|null|nan)(?:\s+(?:undefined|null|nan))+\b|^\W*(?:undefined|null|nan|n/a|untitled|tbd|tba)\W*$|\bjava ?script\b|\blorem ipsum\b|\bforbidden\b|\bcoming soon\b"
)
# Links of a page's frame, which say nothing about the content.
FRAME = re.compile(r"home \| episodes \| about|menu\s+search\s+login|back to home|\bretry\b|الرئيسية \| الحلقات \| اتصل بنا|الرجوع للصفحة الرئيسية")
BLIND = re.compile(r"(?:\bx{2,}\b\W*){5,}")
#: Strings that one part of a rule may be told apart by; more are given up for the next part.
MOST_PIECES = 64
#: Pieces that many texts hold, taken for a rule only where it has no others.
COMMON = set("is are to off add type your the need enter only if ل لكي حتى عشان علشان ضع أضف ادخل أدخل اكتب هنا لاحقا رجاء يرجى الموقع المقطع الحلقة الصفحة الفيديو التسجيل".split())


def _better(a: set[str] | None, b: set[str] | None) -> set[str] | None:
    """Of two sets of pieces the one whose shortest uncommon piece is longer; an empty piece or a line break tells nothing."""
    fit = [x for x in (a, b) if x and all(x) and not any("\n" in t for t in x)]
    return max(fit, key=lambda x: (min(0 if t.strip() in COMMON else len(t) for t in x), -len(x)), default=None)


def _parts(parsed) -> tuple[set[str] | None, set[str] | None]:
    """(every string a parsed expression matches, None if too many; strings of which every match holds one, None if unknown)."""
    whole, exact, best = True, {""}, None
    for op, arg in parsed:
        own, some = _part(op, arg)
        if own is not None and len(exact) * len(own) <= MOST_PIECES:
            exact = {a + b for a in exact for b in own}
        else:
            whole, best, exact = False, _better(best, exact), own if own is not None else {""}
        best = _better(best, some)
    return exact if whole else None, _better(best, exact)


def _part(op, arg) -> tuple[set[str] | None, set[str] | None]:
    if op is sre.LITERAL:
        return {chr(arg)}, None
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return {""}, None
    if op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg):
        return {chr(c) for _, c in arg}, None
    if op is sre.SUBPATTERN:
        return _parts(arg[3])
    if op is sre.BRANCH:
        owns, somes = zip(*map(_parts, arg[1]))
        own = set().union(*owns) if None not in owns else None
        return own if own and len(own) <= MOST_PIECES else None, set().union(*somes) if None not in somes else None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = arg
        own, some = _parts(inner)
        if not least:
            return own | {""} if own and most == 1 else None, None
        times = {"".join(x) for x in product(own, repeat=least)} if own and len(own) ** least <= MOST_PIECES else None
        return times if least == most else None, _better(times, some)
    return None, None


def pieces(rule: re.Pattern) -> set[str]:
    """Literal pieces one of which is in whatever the rule matches, read off the parsed rule itself."""
    found = _parts(sre_parser.parse(rule.pattern))[1]
    if not found:
        raise ValueError(f"no literal piece is common to what {rule.pattern[:60]!r} matches")
    return found


@cache
def _scanner():
    """The literal pieces of all rules as one automaton."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for t in set().union(*map(pieces, (PLACEHOLDERS, BLIND, WEAK, *STRONG.values()))):
        a.add_word(t, t)
    a.make_automaton()
    return a


def _may_hold(tidy: str) -> bool:
    """False only where no rule can match: no literal piece of a rule, and not the three kinds of words of a filler run."""
    if next(_scanner().iter(tidy), None):
        return True
    words = set(re.findall(r"\w+", tidy))
    return len(words & LOREM) > 2 or len(words & MASHED) > 2


def _tidy(text: str) -> str:
    """Lower case, compatibility form, without vowel marks and characters that have no glyph; line breaks stay."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        text = re.sub(r"[ً-ْٰـ­؜​-‏‪-‮⁠-⁤﻿]", "", text)
    return re.sub(r"[^\S\n]+", " ", text.lower())


def masked(text: str) -> str:
    """The text with addresses, dates, identifiers and numbers replaced by their kind."""
    for rule, name in MASKS:
        text = rule.sub(name, text)
    return text.strip(" \n\t.,;:!?؟،-–|>")


def _filler_run(words: list[str], vocabulary: set[str]) -> bool:
    run, kinds = 0, set()
    for w in words:
        if w in vocabulary:
            run += 1
            kinds.add(w)
            if run >= FILLER_RUN and len(kinds) > 2:
                return True
        else:
            run, kinds = 0, set()
    return False


def messages(text: str) -> list[tuple[str, str, bool, bool, bool]]:
    """(rule, masked message, strong, alone, line) of every piece of residue a text may hold.

    A message is the line or sentence a phrase stands in; a placeholder is a message by itself, its name masked, so that
    the same form of field counts as one across documents. alone: nothing but the frame of a page and BESIDE words
    are left of the text beside the message. line: weak phrases make up all words of their line.
    """
    tidy = _tidy(text)
    if not tidy.strip() or not _may_hold(tidy):
        return []
    found: list[tuple[str, str, bool, bool, bool]] = []
    for m in PLACEHOLDERS.finditer(tidy):
        tag = m.group("tag")
        if tag and (tag in PAGE_TAGS - {"summary", "link", "title"} or f"</{tag}" in tidy):
            continue
        form = re.sub(r"[^\W_][\w \-]*", "name", m.group(0))
        found.append(("placeholder", form, True, False, False))
    words = re.findall(r"\w+", tidy)
    if _filler_run(words, LOREM):
        found.append(("filler", "lorem", True, False, False))
    if _filler_run(words, MASHED):
        found.append(("filler", "mashed", True, False, False))
    if BLIND.search(tidy):
        found.append(("filler", "blind", True, False, False))
    bare = FRAME.sub("\n", tidy)
    total = len(re.findall(r"\w+", bare))
    for rule, phrases in STRONG.items():
        for m in phrases.finditer(bare):
            found.append((rule, masked(m.group(0)), True, False, False))
    for line in bare.split("\n"):
        m = WEAK.search(line)
        if m:
            own = len(re.findall(r"\w+", m.group(0)))
            here = len(re.findall(r"\w+", line))
            line_of_own = sum(len(re.findall(r"\w+", p.group(0))) for p in WEAK.finditer(line)) == here
            found.append(("error", masked(line), False, (total - own <= BESIDE) if total <= here + BESIDE else False, line_of_own))
    return found


def residue_messages(documents: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(`key`, source, rule, message, digest, strong, alone, line): every message that some rule may call residue.

    All texts are scanned whole, in the form the rules see, by one automaton of literal pieces read off the rules; the rules
    run where one occurs.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            keys, sources = batch.column(0), batch.column(1).to_pylist()
            for i, t in enumerate(batch.column(2).to_pylist()):
                if t:
                    for rule, message, strong, alone, line in dict.fromkeys(messages(t)):
                        digest = hashlib.blake2b(f"{rule}\0{message}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        rows.append((i, sources[i], rule, message, digest, strong, alone, line))
            cols = list(zip(*rows)) if rows else [()] * 8
            types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.bool_(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(cols[0], pa.int32())), *[pa.array(c, k) for c, k in zip(cols[1:], types)]],
                names=[key, "source", "rule", "message", "digest", "strong", "alone", "line"],
            )

    picked = documents.where(F.col(key).isNotNull()).select(F.col(key), F.col(source).cast("string").alias("source"), F.col(text))
    return picked.mapInArrow(run, f"`{key}` {kind}, source string, rule string, message string, digest binary, strong boolean, alone boolean, line boolean")


def residue(documents: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(`key`, rule, message, sources, by): the documents that hold residue, with what they hold, in how many sources it recurs, and by what it is told.

    Numbers, addresses, dates and identifiers are masked and equal messages grouped by hash across sources. A class of
    messages that recurs in WIDE sources or more is residue by `recurrence` if a rule holds for it: it says what only a
    template, a server or a browser says, or it is a bare phrase that makes up its line. A message that doesn't recur is
    residue by `phrase` if it says the former, or `alone` if the document consists of it. Null and empty texts hold
    nothing, rows without a key are left out; a null source counts as one source; repeated rows of a key count once.
    """
    held = cut(residue_messages(documents, key=key, text=text, source=source).distinct(), "residue")
    spread = held.select("digest", F.coalesce("source", F.lit("")).alias("source")).distinct().groupBy("digest").agg(F.count("*").alias("sources"))
    counted = held.join(spread, "digest")
    by = F.when((F.col("sources") >= WIDE) & (F.col("strong") | F.col("line")), "recurrence").when(F.col("strong"), "phrase").when(F.col("alone"), "alone")
    return counted.withColumn("by", by).where("by IS NOT NULL").select(key, "rule", "message", "sources", "by").distinct()

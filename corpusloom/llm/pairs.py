"""Broken question and answer pairs: empty, cut-off, refusing, parroting and wrong-language answers.

Each pair is judged on its own, so the operator is a single pass without a shuffle. An answer is looked at in this order:

* empty: nothing is left without fences, white space, invisible characters and punctuation, or only a placeholder word;
* refusal: an Aho-Corasick automaton over refusing phrases, for answers that have no code besides comments;
* truncated: it says so, or the stack of delimiters isn't empty at its end, or its last statement, block or sentence is open;
* copy: the question's suffix automaton is traversed with the answer's words; stretches of the question that reappear in the
  answer are covered, and the coverage of both decides;
* language: stopwords and scripts vote on the language of the answer's prose or comments and of the question's.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFECTS = ("empty", "truncated", "refusal", "copy", "language")

#: Whole answers that stand for no answer, without punctuation and case.
PLACEHOLDERS = frozenset("na n/a none null nil nan todo tbd tba fixme empty blank missing pending placeholder undefined unknown answer output code response no_answer noanswer nooutput noresponse nocode notavailable yourcodehere codehere pass".split())

#: Phrases that decline a task, lower case and with plain apostrophes.
REFUSALS = (
    "i can't help", "i cannot help", "i can't assist", "i cannot assist", "unable to assist", "unable to help", "can't help with", "cannot help with",
    "i can't convert", "i cannot convert", "i can't provide", "i cannot provide", "i can't write", "i cannot write", "i can't create", "i cannot create",
    "i can't generate", "i cannot generate", "i can't share", "i cannot share", "i can't do this", "i can't do that", "i cannot do", "can't fulfill", "cannot fulfill", "can't comply", "cannot comply",
    "unable to comply", "unable to provide", "unable to produce", "unable to write", "unable to generate", "unable to convert", "unable to fulfil", "not able to write", "not able to help", "not able to provide", "not able to assist", "not able to produce",
    "not able to convert", "not able to generate", "not able to share", "must decline", "have to decline", "i decline", "i refuse", "refused to", "request refused", "request was refused", "was declined", "declined to", "refuse to write", "refuse to provide",
    "will have to pass on", "have to pass on", "i'd rather not", "i would rather not", "prefer not to", "don't feel comfortable", "do not feel comfortable", "not comfortable", "won't be writing", "will not be writing", "won't write", "will not write", "won't provide", "will not provide",
    "would not be appropriate", "wouldn't be appropriate", "not appropriate for me", "guidelines do not allow", "guidelines don't allow", "against my guidelines", "against my policy", "policy reasons", "policy does not allow", "policies do not allow",
    "not permitted to", "isn't something i'm permitted", "not something i'm permitted", "not allowed to share", "not allowed to provide", "not allowed to write", "outside of what i can do", "outside what i can do", "beyond what i can do", "outside my scope",
    "no code is provided", "no answer can be given", "cannot be completed", "can't be completed", "cannot be fulfilled", "cannot be answered", "as a language model", "as an ai", "for safety reasons", "conversion refused", "request denied", "i'm sorry, but", "i am sorry, but", "sorry, but i", "sorry, i can", "sorry, that is outside",
    "lo siento, pero no", "no puedo ayudar", "no puedo proporcionar", "je ne peux pas", "je suis désolé", "désolé, mais", "es tut mir leid", "kann ich nicht", "ich kann leider", "leider kann ich", "não posso ajudar", "não posso fornecer", "desculpe, mas", "lamento, mas",
    "извините, но", "не могу помочь", "не могу предоставить", "üzgünüm", "yardımcı olamam", "抱歉", "无法提供", "无法帮助", "不能提供", "申し訳", "できません", "お手伝いでき", "mi dispiace, ma", "non posso aiutar",
)

#: Function words by language; single words that several languages use as often are left out.
STOPWORDS = {
    "en": "the and of to is that for with this when while after before only from under above by each then it was on not can has have if its are be who into between whenever so at an will as do does no me we our you your they there here these this those than but any all both more most less over out up down until since per or in about such where which what how should would could must may does been were also same",
    "es": "el los las una del por para con que cuando si más está esta su sobre después antes entre desde cada pero como sin al y se tras mientras hasta durante",
    "pt": "o os as um uma do da dos das por para com que quando se mais está esta seu sobre depois antes entre desde cada mas como sem ao não e em até enquanto abaixo ou",
    "fr": "le les une des du pour avec que quand si plus est cette son sur après avant entre depuis chaque mais comme sans au ne pas et dans lorsque sous la ou puis",
    "de": "der die das ein eine einen des für mit dass wenn mehr ist diese sein auf nach vor zwischen seit jede aber wie ohne und nicht im um von bei unter bis über sich zu den dem während",
    "it": "il gli una della dei per con che quando se più è questa suo sopra dopo prima tra ogni ma come senza al non e nel mentre sotto di lo",
    "tr": "ve bir bu şu için ile ne zaman eğer daha çok az en sonra önce her hiç ama fakat ancak veya ya da gibi olarak değil var yok mı mi kadar olan oldu olur ise iken göre altında üstünde üzerinde üstüne altına içinde arasında karşı doğru çünkü yalnızca sadece bütün tüm bazı aynı diğer böyle şimdi hem ki onun bunun tarafından rağmen itibaren",
    "nl": "het een van dat niet voor zijn naar ook maar bij nog wordt worden door deze wanneer boven geen daarna tussen elke zonder",
    "pl": "nie się jest że jak przez dla ale oraz gdy lub gdzie jeśli nad pod przed każdy bez między tylko już są",
    "id": "dan yang dari untuk dengan pada ini itu tidak adalah akan atau jika saat oleh ketika setelah sebelum antara setiap tanpa lebih",
    "sv": "och att som för på är inte med av när över eller efter före mellan varje utan från till denna",
    "ru": "и в на не что для с когда если больше это его после до между каждый но как без по из при или то а от выше ниже пока чем",
}
#: Letters that speak for languages.
_LETTERS = {"ğ": ("tr",), "ı": ("tr",), "ş": ("tr",), "ü": ("tr", "de"), "ö": ("tr", "de"), "ç": ("tr", "fr", "pt"), "ä": ("de",), "ã": ("pt",), "õ": ("pt",), "ñ": ("es",), "ß": ("de",), "œ": ("fr",), "ł": ("pl",), "ę": ("pl",), "ą": ("pl",), "ż": ("pl",), "å": ("sv",)}
#: Scripts that tell a language, or stand for several (ranges of characters).
_SCRIPTS = (("ru", "Ѐ", "ӿ"), ("el", "Ͱ", "Ͽ"), ("he", "\u0590", "\u05ff"), ("ar", "\u0600", "\u06ff"), ("hi", "\u0900", "\u097f"), ("th", "\u0e00", "\u0e7f"))
_VOTES: dict[str, list[str]] = {}
for _language, _list in STOPWORDS.items():
    for _word in _list.split():
        _VOTES.setdefault(_word, []).append(_language)

#: An answer that says that it goes on.
_GOES_ON = re.compile(
    r"(?:\b(?:cut ?off|truncated|omitted|continue[sd]?|to be continued|not shown|left out|snipped?|elided|abridged|abbreviated)\b|\b(?:rest|remainder|remaining)\b.{0,40}\b(?:omitted|same|unchanged|follows?|here|above|goes|left|later|skipped)\b|\b(?:remaining lines|token limit|length limit|max(?:imum)? length)\b)",
    re.IGNORECASE,
)
_MARKER_LINE = re.compile(r"^\s*(?://|#|--|/\*|<|\[|\(|\*|\.\.\.|…)")
_CONTENT = re.compile(r"\w")
_FENCE = re.compile(r"^[ \t]*```[^\n`]*$", re.MULTILINE)
_LEX = re.compile(r'"""[\s\S]*?"""|\'\'\'[\s\S]*?\'\'\'|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|//[^\n]*|#[^\n]*|/\*[\s\S]*?\*/|"""|\'\'\'|/\*|["\'()\[\]{}]')
_PAIRS = {")": "(", "]": "[", "}": "{"}
_CODE = re.compile(r"[\w\])]\s*(?::=|\+=|-=|(?<![=!<>])=(?!=))\s*\S|[\w\])]\s*(?::=|=)\s*$|^\s*[A-Za-z_][\w.]*\(|\w\.\w+\(|=>|^\s*(?:import|from|class|def|elif|try:|else:|else$|return\b|params\b)|^\s*(?:if|for|while|switch)\s[^.,;!?]{0,80}$", re.MULTILINE)
_TOKEN = re.compile(r"[぀-ヿ㐀-鿿가-힯]|[^\W぀-ヿ㐀-鿿가-힯]+")
_OPEN_END = re.compile(r"(?:[-+*/%=<>,&|?:(\[{.\\]|\b(?:and|or|not|if|else|elif|in|is|to|by|return|import|from|class|def|var|float|int|bool))$")
#: Statements of one word.
_ALONE = frozenset("pass break continue return else try finally".split())
_SENTENCE_END = re.compile(r"[.!?。！？…:;)\]\"'»”*`]$")


_BLOCK = re.compile(r"^[ \t]*```[^\n`]*\n.*?(?:^[ \t]*```[^\n`]*$|\Z)", re.DOTALL | re.MULTILINE)
_WORDS = re.compile(r"[^\W\d_]{2,}")
#: A question of so many words in which no language is recognised is in an unknown one; its answers aren't judged by language.
UNKNOWN_WORDS = 30


def _refusing() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase in REFUSALS:
        automaton.add_word(phrase, phrase)
    automaton.make_automaton()
    return automaton


class SuffixAutomaton:
    """Of a sequence of tokens."""

    def __init__(self, tokens: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.end = [-1], [0], [-1]
        last = 0
        for i, t in enumerate(tokens):
            cur = len(self.next)
            self.next.append({})
            self.length.append(i + 1)
            self.link.append(0)
            self.end.append(i)
            p = last
            while p >= 0 and t not in self.next[p]:
                self.next[p][t] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][t]
                if self.length[q] == self.length[p] + 1:
                    self.link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    self.end.append(self.end[q])
                    while p >= 0 and self.next[p].get(t) == q:
                        self.next[p][t] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def covered(self, tokens: list[str], least: int) -> tuple[int, list[bool]]:
        """Walk the automaton with ``tokens``: how many of them lie in common stretches of ``least`` or more tokens, and which
        tokens of the automaton's sequence do."""
        n = max(self.length) if self.length else 0
        own, mine = [0] * (len(tokens) + 1), [0] * (n + 1)
        state, size = 0, 0
        for i, t in enumerate(tokens):
            while state and t not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if t in self.next[state]:
                state, size = self.next[state][t], size + 1
            else:
                state, size = 0, 0
            if size >= least:
                own[i + 1 - size] += 1
                own[i + 1] -= 1
                e = self.end[state]
                mine[e + 1 - size] += 1
                mine[e + 1] -= 1
        depth, count = 0, 0
        for d in own[:-1]:
            depth += d
            count += depth > 0
        depth, which = 0, []
        for d in mine[:-1]:
            depth += d
            which.append(depth > 0)
        return count, which


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def copied(question: str, answer: str) -> tuple[float, float]:
    """The shares of the answer's and of the question's tokens in common stretches of three or more tokens."""
    q, a = tokens(question), tokens(answer)
    if not q or not a:
        return 0.0, 0.0
    count, which = SuffixAutomaton(q).covered(a, min(3, len(q)))
    return count / len(a), sum(which) / len(q)


def language(text: str, asked: str = "en") -> str | None:
    """One of en, es, pt, fr, de, it, tr, nl, pl, id, sv and, by script, ru (any Cyrillic), zh, ja, ko, el, he, ar, hi, th: by script, else by
    the most votes of stopwords and letters. Null if too little speaks for one: fewer than three votes, and not two different
    stopwords of two or more letters with a lead of two votes over the language ``asked``."""
    han = kana = hangul = latin = 0
    letters: Counter[str] = Counter()
    for ch in text:
        if ch > "˿":
            if "一" <= ch <= "鿿":
                han += 1
            elif "぀" <= ch <= "ヿ":
                kana += 1
            elif "가" <= ch <= "힯":
                hangul += 1
            else:
                for name, low, high in _SCRIPTS:
                    if low <= ch <= high:
                        letters[name] += 1
    ws = re.findall(r"[^\W\d_]+", text.lower())
    latin = sum(w[0] < "̀" for w in ws)
    if han + kana + hangul >= 5 and (han + kana + hangul) * 2 > latin:
        return "ko" if hangul > han + kana else "ja" if kana >= 3 and kana * 8 > han else "zh"
    if letters and letters.most_common(1)[0][1] >= 12 and letters.most_common(1)[0][1] > latin * 2:
        return letters.most_common(1)[0][0]
    votes: Counter[str] = Counter()
    voters: dict[str, set[str]] = {}
    for w in ws:
        of = list(_VOTES.get(w, ()))
        for language in of:
            if len(w) > 1:
                voters.setdefault(language, set()).add(w)
        if not w.isascii():
            of += [x for letter, xs in _LETTERS.items() if letter in w for x in xs]
        for language in of:
            votes[language] += 1
    if not votes:
        return None
    (best, n), second = votes.most_common(1)[0], (votes.most_common(2)[1][1] if len(votes) > 1 else 0)
    if n <= second:
        return None
    clear = len(voters.get(best, ())) >= 2 and n - votes[asked] >= 2
    return best if n >= 3 or clear else None


def _plain(text: str) -> str:
    """Without fences and invisible characters."""
    text = "".join(ch for ch in text if unicodedata.category(ch) != "Cf") if not text.isascii() else text
    return _FENCE.sub("", text).strip()


def _parts(text: str) -> tuple[str, str, bool]:
    """``(code, comments, open)``: the text without strings and comments, its comments and docstrings, and whether a bracket,
    string or block comment is left open at the end."""
    code, comments, stack, at, left = [], [], [], 0, False
    for m in _LEX.finditer(text):
        t = m[0]
        code.append(text[at : m.start()])
        at = m.end()
        if t[0] == "#" and re.match(r"#[0-9A-Fa-f]{6}", t):
            at = m.start() + 1  # a colour
        elif t.startswith(("//", "#", "/*")) and len(t) > 1 or t == "#":
            if t == "/*":
                left = True
                break
            comments.append(t.strip("/#* \t"))
        elif t.startswith(('"""', "'''")):
            if len(t) == 3:
                left = True
                break
            comments.append(t[3:-3])
        elif t in "([{":
            stack.append(t)
            code.append(t)
        elif t in _PAIRS:
            code.append(t)
            if stack and stack[-1] == _PAIRS[t]:
                stack.pop()
        elif len(t) == 1:
            left = True  # a quote without its partner on the line
            code.append(t)
        else:
            code.append('""')
    code.append(text[at:] if not left else "")
    return "".join(code), "\n".join(comments), left or bool(stack)


def judge(question: str | None, answer: str | None, automaton: ahocorasick.Automaton) -> str | None:
    """The answer's defect, or null if it is sound."""
    question = question or ""
    if answer is None:
        return "empty"
    text = _plain(answer)
    bare = re.sub(r"[\W_]+", "", text).lower()
    if not _CONTENT.search(text) or bare in PLACEHOLDERS:
        return "empty"
    fenced = _FENCE.findall(answer)
    inner = answer
    last = ""
    if fenced:
        blocks = re.findall(r"^[ \t]*```[^\n`]*\n(.*?)(?:^[ \t]*```|\Z)", answer, re.DOTALL | re.MULTILINE)
        inner = max(blocks, key=len, default=text)
        if not _CONTENT.search(inner):
            inner = text
        last = blocks[-1] if len(blocks) > 1 and blocks[-1] != inner else ""
    code, comments, unclosed = _parts(inner)
    is_code = bool(_CODE.search(code)) and not _prose(inner, code)
    lines = [x for x in text.split("\n") if x.strip()]
    if not is_code and next(automaton.iter(text.lower().replace("’", "'")), None):
        return "refusal"
    for line in lines[-2:]:
        if (_MARKER_LINE.match(line) or len(lines) == 1) and _GOES_ON.search(line) and (not is_code or not _CODE.search(_parts(line)[0])):
            return "truncated"
    spoken_there = question if not _CODE.search(_parts(question)[0]) else _parts(question)[1]
    asked = language(spoken_there)
    if asked is None and len(_WORDS.findall(spoken_there)) < UNKNOWN_WORDS:
        asked = "en"
    if is_code:
        if unclosed or len(fenced) % 2:
            return "truncated" if not _copy(question, text, True) else "copy"
        if _open_end(inner, code) or last and _CODE.search(_parts(last)[0]) and (_parts(last)[2] or _open_end(last, _parts(last)[0])):
            return "truncated"
        if _copy(question, inner, True):
            return "copy"
        outside = _BLOCK.sub("\n", answer) if fenced and asked else ""
        spoken = next((s for s in (language(c, asked or "en") for c in (comments, outside)) if s and s != asked), None)
    else:
        if _copy(question, text, False):
            return "copy"
        spoken = language(text, asked or "en")
    if spoken and asked and spoken != asked:
        return "language"
    if not is_code:
        last = text.rstrip()
        if not _SENTENCE_END.search(last) and len(tokens(last)) >= 4 or last.endswith(("...", "…")):
            return "truncated"
    return None


def _prose(text: str, code: str) -> bool:
    """Running text rather than code: hardly any line looks like code."""
    lines = [x for x in code.split("\n") if x.strip()]
    return sum(bool(_CODE.search(x)) for x in lines) * 4 < len(lines) and len(lines) > 1 if lines else True


def _open_end(text: str, code: str) -> bool:
    """The last statement or block of code lacks its rest."""
    lines = [x for x in code.split("\n") if x.strip()]
    if not lines:
        return False
    last = lines[-1].rstrip()
    if _OPEN_END.search(last):
        return True
    name = re.fullmatch(r"\s*(?:(?:def|class)\s+)?([A-Za-z_][\w.]*)", last)
    if name and (re.match(r"\s*(?:def|class)\s", last) or name[1] not in _ALONE and not re.search(rf"(?<![\w.]){re.escape(name[1])}(?![\w.])", code[: code.rindex(last)])):
        return True  # broken off inside a name
    if last.endswith(("...", "…")):
        return True
    if last.endswith("=>") or re.match(r"\s*(?:if|for|while|switch|else if|elif)\b(?!.*\?)[^\n]*$", last) or last.strip() == "else":
        return True
    return False


def _copy(question: str, answer: str, is_code: bool) -> bool:
    if not question.strip():
        return False
    if is_code and not _CODE.search(_parts(question)[0]):
        return False  # code that answers prose adds to it
    of_answer, of_question = copied(question, answer)
    return of_answer >= 0.7 and of_question >= 0.5


def broken_pairs(df: DataFrame, key: str, question: str, answer: str, judged: str | None = None) -> DataFrame:
    """(key, defect): each row of ``df`` whose answer is defective and its defect, one of ``DEFECTS``; rows for which the
    condition ``judged`` (SQL) isn't true are no cases. One pass, no shuffle. A null answer is empty; a null question leaves
    the checks that need it out and counts as English, as does one of few words; a long one in a language that isn't recognised (see
    ``language`` for those that are) leaves the check of the language out. Null or repeated keys are kept as they are. Other columns are not read.
    """
    kind = df.schema[key].dataType
    rows = (df.where(judged) if judged else df).select(F.col(key).alias("__key"), F.col(question).cast("string").alias("__q"), F.col(answer).cast("string").alias("__a"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _refusing()
        for batch in batches:
            text = lambda x: x if isinstance(x, str) else None
            found = batch.assign(defect=[judge(text(q), text(a), automaton) for q, a in zip(batch["__q"], batch["__a"])])
            yield found.loc[found["defect"].notna(), ["__key", "defect"]]

    return rows.mapInPandas(run, T.StructType([T.StructField("__key", kind), T.StructField("defect", T.StringType())])).withColumnRenamed("__key", key)

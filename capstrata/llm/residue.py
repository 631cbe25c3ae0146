"""Problem 4: template residue, filler, error messages and notices in place of a description.

Texts are cut into passages; a bracketed expression is a passage of its own. A naive Bayes model over the passages'
words is learned from trusted error and placeholder passages and unlabelled ones: expectation-maximization starts with
all unlabelled passages as descriptions and lets those that look like the trusted ones change sides. A record is residue
when its most suspicious passage is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .canon import repair
from .common import require, sample_share

SAMPLE_ROWS = 40_000  # bound of the rows that the classifier is fitted on, a share by a hash of their id
ROUNDS = 4
BITS = 18
SMOOTH = 0.05
LEAST = 2.2  # log-odds of a passage
LEAST_WORD = 8  # a word in fewer passages of the sample is a rare one
#: What trusted passages are: placeholders of templates, filler, error messages and notices.
TRUSTED = [
    r"\{\{[^{}]*\}\}", r"\$\{[^{}]*\}", r"#\{[^{}]*\}", r"\{%.*%\}", r"<%.*%>", r"%\(\w+\)s", r"%[sd]", r"@@\w+@@", r"__[a-z_]{3,}__", r"\[\[[^\[\]]*\]\]", r"\[object \w+\]", r"\{[a-z_.]+\}",
    r"<(?:your )?[a-z]+(?: [a-z]+)?>", r"\[[^\[\]]* goes here\]", r"\[insert [^\[\]]* here\]",
    r"lorem ipsum.*", r"(?:dolor sit amet|consectetur adipiscing).*", r"(?:blah ?){2,}", r"(?:x{3,} ?){2,}", r"(?:dummy|sample|placeholder|test)(?: (?:dummy|text|test|caption))+(?: \d+)?", r"tbd|todo.*|asdf.*|untitled|undefined|null|n/a|nan",
    r"(?:some )?(?:sample|dummy|placeholder|example) (?:text|wording|caption).*", r"your (?:caption|text|title) (?:goes )?here", r"(?:write|type|enter|add|insert) (?:a|an|your|some|something)\b.*(?:caption|description|photo|text|here).*",
    r"(?:oops!? ?)?(?:http |error |server said |status code )?(?:http |error )?[45]\d\d[: -]*(?:not found|forbidden|bad gateway|service unavailable|access denied|internal (?:server )?error|too many requests|gone|bad request|gateway timeout|unauthorized)?",
    r"(?:not found|access denied|forbidden|bad gateway|service unavailable|internal (?:server )?error|too many requests|gateway timeout|page not found|image removed|image not available)",
    r"(?:please )?(?:enable|turn on|activate|switch on) javascript.*", r"javascript (?:is|must be) .*", r".*scripts? (?:is|are) (?:blocked|disabled|required).*", r"(?:please )?accept (?:all )?cookies.*", r"(?:prove|confirm) (?:that )?you are (?:not a robot|human).*", r"(?:your )?browser is being checked.*", r"checking your browser.*", r".*without script support.*", r".*no longer (?:on this server|available).*",
    r"bildbeschreibung.*ergänzen", r"hier steht ihr.*", r"bitte javascript.*", r".*(?:benötigt|braucht) (?:aktive )?skripte.*", r"seite nicht gefunden.*", r"zugriff verweigert.*", r"dienst .*nicht (?:erreichbar|verfügbar).*", r"(?:das|dieses) bild wurde (?:entfernt|gelöscht).*", r"(?:platzhalter|beispiel|blind)text.*", r"zu viele anfragen.*", r"beschreibung folgt.*",
    r"veuillez activer.*", r"votre (?:légende|texte) ici", r"légende à compléter", r".*exige les scripts.*", r"page (?:introuvable|non trouvée).*", r"accès refusé.*", r"service (?:momentanément )?indisponible.*", r"(?:l.|cette )image a été (?:supprimée|retirée).*", r"(?:texte d.exemple|exemple de texte|texte de remplissage).*", r"trop de requêtes.*", r"description à venir.*",
    r"active javascript.*", r".*necesita scripts.*", r"escriba aquí.*", r"página no encontrada.*", r"acceso denegado.*", r"servicio no disponible.*", r"la imagen (?:fue|ha sido) .*", r"texto de (?:relleno|ejemplo|muestra).*", r"demasiadas (?:solicitudes|peticiones).*", r"descripción pendiente.*",
    r"ative o javascript.*", r".*precisa de scripts.*", r"escreva aqui.*", r"legenda por preencher.*", r"página não encontrada.*", r"acesso negado.*", r"serviço indisponível.*", r"a imagem foi (?:removida|excluída).*", r"texto de (?:exemplo|preenchimento).*", r"demasiados pedidos.*|muitas solicitações.*", r"descrição pendente.*",
    r"включите javascript.*", r".*нужны скрипты.*", r"здесь будет.*", r"добавьте описание.*", r"страница не найдена.*", r"доступ запрещ[её]н.*", r"сервис (?:временно )?недоступен.*", r"изображение удалено.*", r"(?:пример|образец) текста.*", r"слишком много запросов.*", r"описание (?:появится|будет).*",
    r"请(?:启用|开启|输入|填写).*", r"此处填写.*", r"浏览器未(?:开启|启用).*", r".*需要(?:启用)?脚本.*", r"(?:页面|网页)(?:不存在|未找到).*", r"拒绝访问.*", r"(?:服务)(?:暂时|暂)?不可用.*", r"图片(?:已被|已)删除.*", r"(?:示例|占位)(?:文字|文本).*", r"请求过于频繁.*|请求过多.*", r"描述待(?:补充|添加).*",
]
_trusted = re.compile("(?:" + "|".join(TRUSTED) + r")(?: ?\([0-9a-f]{3,}\))?[.!?…]*", re.I)
_bracketed = re.compile(r"\{\{.*?\}\}|\{%.*?%\}|<%.*?%>|[$#]?\{[^{}]*\}|%\(\w+\)s|%[sd](?!\w)|@@\w+@@|__\w+?__|\[\[[^\[\]]*\]\]|\[[^\[\]]*\]|<[^<>]{1,40}>")
_stops = re.compile(r"[.!?]+(?:\s+|$)|[。！？…\n|;；]+")
_token = re.compile(r"[一-鿿]+|[^\W\d_一-鿿]+|\d\w*|[^\W_]+")
_inner = re.compile(r"[^\W_]+")
_hex = re.compile(r"(?=.*\d)[0-9a-f]{6,}$", re.I)


def passages(text: str) -> list[str]:
    out: list[str] = []
    plain = text
    if any(c in text for c in "{[<%@_"):
        found = _bracketed.findall(text)
        if found:
            out += found
            plain = _bracketed.sub(" \n ", text)
    out += _stops.split(plain)
    return [q for p in out if p and (q := p.strip(" ,:-/"))]


def tokens(passage: str, common: set[str] | None) -> list[str]:
    """Words, with rare ones, numbers and codes as one sign each; Chinese in pairs of characters. An expression in
    brackets adds its shape, the brackets with the kinds of what they hold."""
    out = ["^"]
    if passage[0] in "{[<%@_$#" and _bracketed.fullmatch(passage):
        out.append(_inner.sub(lambda m: "0x" if _hex.match(m[0]) else "0" if m[0].isdigit() else "W" if m[0][0].isupper() and not m[0].isupper() else "w", passage))
    for t in _token.findall(passage):
        if "一" <= t[0] <= "鿿":
            out += [t[i : i + 2] for i in range(max(1, len(t) - 1))] if common is None else [p if (p := t[i : i + 2]) in common else "汉" for i in range(max(1, len(t) - 1))]
            continue
        low = t.lower()
        if low.isdigit():
            out.append("000" if len(low) == 3 else "0")
        elif _hex.match(low):
            out.append("0x")
        elif common is None or low in common or not t[0].isalpha():
            out.append(low)
        else:
            sign = "N" if t[0].isupper() else "n"
            if out[-1] != sign:  # a row of rare words is one sign
                out.append(sign)
    out.append("$")
    return out


def features(words: list[str]) -> list[int]:
    mask = (1 << BITS) - 1
    return [xxhash.xxh32_intdigest(w) & mask for w in words[1:-1]] + [xxhash.xxh32_intdigest(a + " " + b) & mask for a, b in zip(words, words[1:])]


class Residue:
    def __init__(self, common: set[str], weight: np.ndarray, prior: float):
        self.common, self.weight, self.prior = common, weight.astype(np.float32), prior
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def passage(self, text: str) -> float:
        """Log-odds of a passage."""
        words = tokens(text, self.common)
        key = " ".join(words)
        value = self.known.get(key)
        if value is None:
            if len(self.known) > 100_000:
                self.known.clear()
            value = self.known[key] = self.prior + float(self.weight[features(words)].sum())
        return value

    def score(self, text: str | None) -> float:
        """The greatest log-odds among a text's passages; of none, a large negative number."""
        if not text:
            return -99.0
        return max((self.passage(p) for p in passages(text if text.isascii() else repair(text)) if any(c.isalnum() or c in "%@" for c in p)), default=-99.0)

    def found(self, text: str | None) -> bool:
        return self.score(text) > LEAST


def plain_matches() -> list[str]:
    """The plainest match of each trusted pattern, where it has one: it stands for the pattern that no row of a sample matches."""
    out = []
    for pattern in TRUSTED:
        for one in pattern.split("|") if "(" not in pattern else [pattern]:
            text, old = one, None
            while text != old:  # the first choice of each group, nothing for what may be left out
                text, old = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(?:\?|\{2,\})?", r"\1", text), text
            text = re.sub(r"\.\*|\\b|.\?", "", text).replace(r"d.", "d'").replace("l.", "l'")
            if not re.search(r"[\\()\[\]{}+*?^$]", text) and _trusted.fullmatch(text):
                out.append(text)
    return out


def learn(texts: list[str]) -> Residue:
    """Positive-unlabelled naive Bayes by expectation-maximization over the passages of a bounded sample."""
    counted = Counter(p for t in texts if t for p in passages(repair(t)))
    for p in plain_matches() if counted else []:
        counted[p] = max(counted[p], 2)
    sure = {p for p in counted if _trusted.fullmatch(p)}
    words = Counter()
    for p, n in counted.items():
        words.update(dict.fromkeys(tokens(p, None), n))
    common = {w for w, n in words.items() if n >= LEAST_WORD} | {w for p in sure for w in tokens(p, None)}
    # Passages that differ in rare words only are one row of the model, and a hot one counts less than in proportion.
    kinds, positive = Counter(), Counter()
    for p, n in counted.items():
        kind = tuple(tokens(p, common))
        kinds[kind] += n
        positive[kind] += n * (p in sure)
    rows = list(kinds)
    lists = [features(list(k)) for k in rows]
    size = np.array([len(x) for x in lists], np.int64)
    flat, owner = np.array([i for x in lists for i in x], np.int64), np.repeat(np.arange(len(rows)), size)
    n = np.sqrt(np.array([kinds[k] for k in rows], float))
    trusted = np.array([positive[k] > 0.5 * kinds[k] for k in rows], bool)
    posterior = trusted.astype(float)
    weight, prior = np.zeros(1 << BITS), -5.0
    for _ in range(ROUNDS if trusted.any() else 0):
        shares = []
        for side in (posterior * n, (1 - posterior) * n):
            c = np.bincount(flat, side[owner], 1 << BITS) + SMOOTH
            shares.append(np.log(c / c.sum()))
        weight = shares[0] - shares[1]
        prior = float(np.log((posterior * n).sum() / max(1e-9, ((1 - posterior) * n).sum())))
        odds = prior + np.bincount(owner, weight[flat], len(rows))
        posterior = np.where(trusted, 1.0, 1 / (1 + np.exp(-np.clip(odds - LEAST, -50, 50))))
    return Residue(common, weight, prior) if trusted.any() else Residue(common, weight, -99.0)


def train(df: DataFrame, id_col: str = "pair_id", text_col: str = "caption") -> Residue:
    """The classifier, fitted on about SAMPLE_ROWS rows at any size."""
    picked = sample_share(require(df, id_col, text_col), id_col, SAMPLE_ROWS).where(F.length(text_col) > 0)
    return learn(sorted(r[0] for r in picked.select(text_col).collect()))


def scored(df: DataFrame, id_col: str = "pair_id", text_col: str = "caption", model: Residue | None = None) -> DataFrame:
    """(id, residue, log_odds): for every row whether its text is or contains residue.

    Null, blank and mere punctuation: false. Repeated rows: a row each. An empty table gives no rows.
    """
    source = require(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model or train(df, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            odds = [judge.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v > LEAST for v in odds], pa.bool_()), pa.array(odds, pa.float64())], ["id", "residue", "log_odds"])

    return source.mapInArrow(run, "id bigint, residue boolean, log_odds double")

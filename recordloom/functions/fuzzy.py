"""What built-in expressions can't do: decomposition of all scripts, Indic to Latin, and the matching-blocks ratio. Arrow-batched."""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Devanagari business words in Latin script.
HINDI_WORDS = {
    "एंटरप्राइजेज": "enterprises", "इन्टरप्राइजेज": "enterprises", "इंटरप्राइजेज": "enterprises", "इंटरप्राइज": "enterprise",
    "उद्योग": "udyog", "उद्योगों": "udyog", "प्राइवेट": "private", "प्रा": "pvt", "लिमिटेड": "limited", "लि": "ltd", "कंपनी": "company",
    "ट्रेडर्स": "traders", "ट्रेडिंग": "trading", "स्टोर्स": "stores", "स्टोर": "store", "दुकान": "store", "सर्विसेज": "services", "सर्विस": "service",
    "संस": "sons", "ब्रदर्स": "brothers", "एसोसिएट्स": "associates", "एंड": "and", "श्री": "shri", "महालक्ष्मी": "mahalaxmi", "लक्ष्मी": "laxmi",
    "गणेश": "ganesh", "बालाजी": "balaji", "कृष्णा": "krishna", "शिव": "shiva", "होटल": "hotel", "रेस्टोरेंट": "restaurant", "भंडार": "bhandar",
    "मेडिकल": "medical", "फार्मा": "pharma", "टेक्सटाइल्स": "textiles", "ज्वेलर्स": "jewellers", "ऑटो": "auto", "मोटर्स": "motors",
    "इंटरनेशनल": "international", "इन्टरनेशनल": "international", "लॉजिस्टिक्स": "logistics", "लॉजिस्टिक": "logistics",
    "टेक्नोलॉजी": "technology", "टेक्नोलॉजीज": "technologies", "इंजीनियरिंग": "engineering", "कंस्ट्रक्शन": "construction",
    "इंफ्रास्ट्रक्चर": "infrastructure", "इंफ्रा": "infra", "ग्लोबल": "global", "सिक्योरिटी": "security", "फाइनेंस": "finance", "फाइनेंशियल": "financial",
    "इंडिया": "india", "इंडियन": "indian", "डेवलपर्स": "developers", "प्रॉपर्टीज": "properties", "केमिकल्स": "chemicals",
    "इलेक्ट्रिकल्स": "electricals", "इलेक्ट्रॉनिक्स": "electronics", "मैनेजमेंट": "management", "कंसल्टेंसी": "consultancy", "कंसल्टेंट्स": "consultants",
    "एग्रो": "agro", "फूड्स": "foods", "पैकर्स": "packers", "मूवर्स": "movers", "हाईटेक": "hitech", "हाइटेक": "hitech", "एस्टेट": "estate", "इस्टेट": "estate",
}

# Devanagari signs in Latin script.
HINDI_SIGNS = {
    "अ": "a", "आ": "aa", "इ": "i", "ई": "ee", "उ": "u", "ऊ": "oo", "ऋ": "ri", "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au",
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "ng", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "ny",
    "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n",
    "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "व": "v", "श": "sh", "ष": "sh", "स": "s", "ह": "h",
    "ा": "a", "ि": "i", "ी": "ee", "ु": "u", "ू": "oo", "ृ": "ri", "े": "e", "ै": "ai", "ो": "o", "ौ": "au", "ं": "n", "ँ": "n", "ः": "h", "्": "",
    "०": "0", "१": "1", "२": "2", "३": "3", "४": "4", "५": "5", "६": "6", "७": "7", "८": "8", "९": "9",
}

_TO_DEVANAGARI = {c: 0x900 + c % 0x80 for c in range(0x980, 0xD80)}  # the scripts' blocks are laid out alike
_SIGNS = str.maketrans(HINDI_SIGNS)
_NOT_DEVANAGARI = re.compile("[^ऀ-ॿ]")


def indic_to_latin(text: str) -> str:
    """Words of Indic scripts by dictionary, else sign by sign; other text stays as it is."""
    text = text.translate(_TO_DEVANAGARI)
    if not any("ऀ" <= c <= "ॿ" for c in text):
        return text
    return " ".join(HINDI_WORDS.get(_NOT_DEVANAGARI.sub("", w)) or w.translate(_SIGNS) for w in text.split())


def fold_text(text: str | None) -> str:
    plain = unicodedata.normalize("NFKD", indic_to_latin((text or "").strip()))
    return "".join(c for c in plain if not unicodedata.combining(c)).lower()


def ratio(a: str | None, b: str | None) -> float:
    """2 * matching characters / all; order matters, the anchor comes first."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


@functools.lru_cache(4096)
def _vector(text: str) -> tuple[dict[str, float], float]:
    """Weights of a text's 3-grams and their length. A text is compared with many others one after another."""
    padded = f"#{text}#"
    weights = {g: 1 + math.log(n) for g, n in sorted(Counter(padded[i : i + 3] for i in range(max(1, len(padded) - 2))).items())}
    return weights, math.sqrt(sum(w**2 for w in weights.values()))


def gram_cosine_of(a: str | None, b: str | None) -> float:
    """Cosine of two strings' 3-gram vectors with weights 1 + ln tf; 1 for equal strings, 0 for an empty one."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    (x, x_size), (y, y_size) = _vector(a), _vector(b)
    return min(1.0, sum(x[g] * y[g] for g in sorted(x.keys() & y.keys())) / (x_size * y_size))


@F.pandas_udf(T.StringType())
def fold_any(texts: pd.Series) -> pd.Series:
    return texts.map(fold_text)


@F.pandas_udf(T.StringType())
def indic_fold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: indic_to_latin(t or ""))


@F.pandas_udf(T.DoubleType())
def char_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def gram_cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([gram_cosine_of(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

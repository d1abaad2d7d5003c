"""Romanised slugs for file names."""

from __future__ import annotations

import unicodedata

from digestloom.functions.arrays import let, lit, transform

# Initial, medial and final letters of a Hangul syllable, in code order.
INITIALS = "g gg n d dd r m b bb s ss - j jj c k t p h".split()
MEDIALS = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split()
FINALS = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split()

# Hanja readings seen in headlines.
HANJA = {
    "韓": "han", "美": "mei", "中": "zhong", "日": "ri", "株": "zhu", "比": "bi", "協": "xie",
    "人": "ren", "車": "che", "李": "li", "佛": "fo", "北": "bei", "通": "tong", "前": "qian",
}

# Signs that read as several characters, and letters without a base letter.
SIGNS = {
    "㎡": "m2", "①": "1", "②": "2", "③": "3", "④": "4", "⑤": "5", "⑥": "6", "⑦": "7",
    "⑧": "8", "⑨": "9", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o",
    "Ø": "O", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "đ": "d",
    "Đ": "D", "ı": "i",
}

# Readings of Cyrillic and Greek letters.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
    "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia",
    "ё": "io", "є": "ie", "і": "i", "ї": "yi",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}

# Kana whose reading is not their Unicode name.
KANA = {"si": "shi", "ti": "chi", "tu": "tsu"}

MAX_LENGTH = 50


def _kana(char: str) -> str | None:
    """Reading of one Kana: the last word of its Unicode name."""
    name = unicodedata.name(char, "")
    if not name.startswith(("HIRAGANA LETTER ", "KATAKANA LETTER ")):
        return None
    last = name.split()[-1].lower()
    return KANA.get(last, last)


def _of_base(letters: dict[str, str], char: str) -> str | None:
    """Reading of a letter in either case, with or without marks."""
    low = char.lower()
    if low in letters:
        return letters[low]
    base, *marks = unicodedata.normalize("NFD", low)
    return letters.get(base) if all(map(unicodedata.combining, marks)) else None


# Blocks of code points whose letters are read one by one: first, last, and the rule.
BLOCKS = (
    (0x370, 0x3FF, lambda c: _of_base(GREEK, c)),
    (0x400, 0x45F, lambda c: _of_base(CYRILLIC, c)),
    (0x1F00, 0x1FFF, lambda c: _of_base(GREEK, c)),
    (0x3041, 0x30FA, _kana),
    (0xFF01, 0xFF5E, lambda c: unicodedata.normalize("NFKC", c)),
    (0xFF66, 0xFF9D, lambda c: _kana(unicodedata.normalize("NFKC", c))),
)


def accents() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from Unicode decompositions."""
    marked, plain = [], []
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00)):
        base, *marks = unicodedata.normalize("NFKD", chr(code))
        if base.isascii() and base.isalnum() and all(map(unicodedata.combining, marks)):
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


def _letters(names: list[str], index: str) -> str:
    listed = ", ".join(lit("" if n == "-" else n) for n in names)
    return f"get(array({listed}), {index})"


def _hangul(char: str) -> str:
    at = f"(ascii({char}) - 44032)"
    return (
        f"concat({_letters(INITIALS, f'int({at} div 588)')}, "
        f"{_letters(MEDIALS, f'int({at} % 588 div 28)')}, {_letters(FINALS, f'{at} % 28')})"
    )


def _block(char: str, first: int, last: int, rule) -> str:
    """Reading of a letter of one block: a constant array has it at the letter's place."""
    readings = [rule(chr(code)) for code in range(first, last + 1)]
    # One literal that is split when the query is planned, instead of one per letter; a tab means none.
    listed = f"split({lit(' '.join(chr(9) if r is None else r for r in readings))}, ' ')"
    at = f"get({listed}, ascii({char}) - {first})"
    return f"WHEN ascii({char}) BETWEEN {first} AND {last} THEN coalesce(nullif({at}, {lit(chr(9))}), {char}) "


def romanise(text: str) -> str:
    """ASCII spelling of Hangul, Kana, Cyrillic, Greek, known Hanja and accented Latin letters.

    Other letters stay as they are; ``operators.transliterate`` reads them from a given table.
    """
    blocks = lambda c: "".join(_block(c, *b) for b in BLOCKS)
    hanja = ", ".join(f"{lit(k)}, {lit(r + ' ')}" for k, r in HANJA.items())

    def spell(c: str) -> str:
        return (
            f"CASE WHEN ascii({c}) BETWEEN 44032 AND 55203 THEN {_hangul(c)} {blocks(c)}"
            f"ELSE coalesce(try_element_at(map({hanja}), {c}), {c}) END"
        )

    def spelled(t: str) -> str:
        east_asian = lit(r"[\x{370}-\x{45F}\x{1F00}-\x{1FFF}\x{2E80}-\x{D7FF}\x{F900}-\x{FAFF}\x{FF01}-\x{FF9D}]")
        each = f"array_join({transform(f'''split({t}, '')''', spell)}, '')"
        return f"CASE WHEN regexp_like({t}, {east_asian}) THEN {each} ELSE {t} END"

    wide = let(text, spelled)
    for sign, ascii_text in SIGNS.items():
        wide = f"replace({wide}, {lit(sign)}, {lit(ascii_text)})"
    marked, plain = accents()
    return f"translate({wide}, {lit(marked)}, {lit(plain)})"


def unspelled(text: str) -> str:
    """Letters and digits of a title that no reading covers: a slug drops them."""
    left = f"regexp_replace({romanise(text)}, {lit(r'[^\p{L}\p{N}]|[A-Za-z0-9]')}, '')"
    return f"length(coalesce({left}, ''))"


def slugify(text: str, max_length: int = MAX_LENGTH) -> str:
    """Lower-case ASCII words joined with single dashes, cut to ``max_length``."""
    slug = romanise(f"""regexp_replace({text}, {lit("'+")}, '-')""")
    slug = f"lower(regexp_replace({slug}, {lit('[‘’‛′]')}, ''))"
    slug = f"regexp_replace({slug}, '([0-9]),(?=[0-9])', '$1')"
    slug = f"regexp_replace({slug}, '[^a-z0-9]+', '-')"
    slug = f"regexp_replace({slug}, '^-|-$', '')"
    return f"regexp_replace(substring({slug}, 1, {int(max_length)}), '-$', '')"

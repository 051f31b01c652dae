"""Letter-pair figures of Western text, and the legacy encoding under which a text reads best.

Text of one single-byte encoding read as another has the same bytes under both, so nothing but the letters tells. For each character beyond
ASCII the model has how often it occurs and between which neighbours; a reading's score is the sum of the logarithms over its
characters. All readings of a text have the same positions, so scores compare.

The model is fitted on clean sample sentences of the languages of Western and Central Europe, part of this module: no other row of a corpus has a say in a text's result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

# Sample sentences, written for this purpose; each language's letters beyond ASCII in ordinary words.
SAMPLE = """
The company’s plan isn’t final; we’ve said it won’t change the lessor’s rights, and they’re sure it’s fair. “We shipped more,” the bank’s chairman said, “than in any year.” The registrants’ notes — due in May — bear 5% interest. Under § 7.2 and § 12 of the Act’s rules the cost was €5.3 million, or £4 a unit. Revenue – net of returns – rose. It doesn’t matter that he’d paid; I’m told they’ll pay. The café’s lease was renewed… • Item one • Item two © 2011 the Registrant® and Brand™ products, 20° C, ½ inch, ¼ mile, ±2%, 5 × 3 and 7 ÷ 2. Don’t say ‘never’ or ‘almost’. The directors’ fees were $3 million; the officers’ pay fell. The résumé was sent. Its plant’s output—the region’s largest—was sold. Employees’ shares, holders’ votes and years’ work. The bonds’ fair value and customers’ deposits. “The fund’s fees,” “a unit’s price” and “The trust” were defined (“Plan”), (the “Notes”) and (‘the Act’). She’s here. You’re late. ¢5 and ¥300 were paid¹ in full² under note³. The rate is ƒ(x) = µ·x² + ½ and f(y) = µ·y² − 2·π·r, where Ω ≤ 5 and α ≥ 1. A loss of €20.4 million, of which €3 and €519.5 were in cash; debts of £6.5 million. Over ten years\u00a0– one part each year; Part 2\u00a0– Results; Note\u00a07, page\u00a012, § 4\u00a0and ¶ 9; amounts are in €, in £ and in ¥; see ¶ 3. Names with ™ and ® and © marks: ™ and ® are the owner’s.
La société a cédé son usine de pièces détachées à l’été, naïve et gâtée. Le chiffre d’affaires s’élève à 5 €, grâce à la clientèle. L’année dernière, le bénéfice a été réduit ; les intérêts étaient élevés. Où êtes-vous ? Le maître d’œuvre a reçu un prêt très élevé de la même banque. Le conseil a décidé de créer une filiale française dès que possible. L’âge moyen des employés, après la réunion, a diminué. « Noël » et maïs, île, aîné, coûts, sûr, goût, août, dû, hôtel, côté, contrôle, bientôt. Les états financiers consolidés ont été arrêtés. À la suite de l’opération, Émile et Étienne ont préféré rester. Les coûts d’acquisition ont été réévalués, les dépenses générées. Cœur, sœur, vœu, bœuf, manœuvre. Le bâtiment, la tâche, château, pâte. Français, façon, leçon, garçon, reçu, ça. Dépôts, pôle, trône, rôle. Forêt, arrêt, fête, intérêt, bête, têtes. Système, problème, règle, père, frère, dernière, première, matière, manière. Haïti, Israël, coïncidence, ambiguë, aiguë. Déjà, là, voilà, delà. Connaître, paraît, boîte, chaîne, fraîche. Où, pénurie, équipe, école, écart, énergie, échange, économie, été, évolution.
Der Umsatz stieg im Jahr für das Geschäft über die Maßnahmen. Die Rückstellungen betrugen höhere Erträge. Größe, Straße, Fuß, groß, schließlich, müssen, können, möglich, während, natürlich, zurück, Rückgang, gegenüber, für, früher, künftig, Verkäufe, Verträge, Zuschüsse, Verhältnis, Gebäude, Schäden, Löhne, Erlöse, Vermögen, Behörde, wöchentlich, öffentlich, Öffnung, Übernahme, Änderung, Ähnlich, überprüft, später, erhöht, „Qualität“ und „Größe“, gemäß, außerdem, heißt, weiß, Beschlüsse, Anhänge, Kürzung, Führung, Prüfung, Gewährleistung, Wärme, Fläche, Läden, Mängel, Fälle, Bänke, dürfen, würde, Bündel, Grün, fünf, zwölf, Söhne, König, schön, hören, lösen, Zölle, Böden, Gefäß, Spaß, Gruß, München, Köln, Nürnberg, Österreich, jährlich, vierteljährlich, Beiträge, Erklärung, Ergänzung, zusätzlich, unabhängig, nächste, Stärke, beschäftigt, Tätigkeit, Aktivität, Liquidität, tatsächlich, Gespräche.
La pérdida cambiaria del último trimestre según informó el señor. El año en que la producción de la región creció más de lo previsto. ¿Qué ocurrió con los préstamos? ¿Cuándo se pagó? ¿Cómo? ¿Dónde? ¿Quién? ¡Atención! Se pagaron los días del código. La compañía señaló que también podría vender acciones. España, país, Perú, Bogotá, México, Panamá, así, allí, aquí, está, están, será, después, además, interés, través, inglés, francés, crédito, débito, público, técnico, médico, período, líquido, artículo, título, número, única, junio, millón, razón, opinión, inversión, división, sesión, reunió, aprobó, aumentó, disminuyó, subió, bajó, cayó, perdió, vendió, compró, pagará, tendrá, deberá, energía, garantía, minería, economía, mayoría, tecnología, había, podía, tenía, niño, pequeño, mañana, daño, dueño, desempeño, otoño, ñandú, vergüenza, lingüística, pingüino, árbol, área, él, éxito, índice, órgano, ámbito, «mercado», fácil, difícil, útil, móvil, móviles, automóvil, Ángel, Álvarez, Núñez, Muñoz, García, Martínez, Rodríguez, González. Óscar y Íñigo. Aún, según, algún, ningún, común, atún. Cómo, dónde, quién, cuál, cuánto, sólo, tú, mí, sí, té, más, dé. La empresa—la mayor del sector—vende; el grupo—sin la filial—creció—según se dijo—un poco. El tramo Madrid–Lisboa, precio–valor, páginas 3–5. Capítulo, cálculo, máquina, página, básico, práctico, clásico. Décimo, séptimo, método, época. 1.º y 2.ª.
A produção da empresa não foi entregue no prazo; as ações e opções de março estão em situação regular. O conselho aprovou a emissão de debêntures. São Paulo, não, então, mão, irmão, pão, avião, verão, são, estão, serão, poderão, milhão, milhões, bilhões, ações, obrigações, operações, condições, informações, reduções, previsões, decisões, razões, informação, administração, adição, provisão, previsão, divisão, ocasião, região, cidadão, órgão, órgãos, mães, alemães, põe, propõe, à vista, às vezes, àquele, também, além, porém, ninguém, armazém, você, três, mês, inglês, português, câmbio, âmbito, finança, finanças, diferença, licença, serviço, preço, balanço, espaço, início, exercício, benefício, negócio, contrário, salário, funcionário, necessário, último, únicos, público, crédito, período, líquido, média, mídia, lucro, país, saída, juízo, ruína, saúde, conteúdo, já, há, lá, será, está, até, é, pé, café, avó, pó, só, após, voo, cinquenta, têm, vêm, ônus, ônibus, bônus, econômico, eletrônico, endereço, cabeça, força, março, março, aço, braço, ção, peça, caça, maçã, lã, manhã, amanhã, irmã, constituíção, atribuída, incluída, reduziu, próprio, próxima, histórico, relatório, acionária, tributária, monetária, Índia, África, Ásia. O grupo—sem a filial—cresceu; a linha Porto–Lisboa, páginas 3–5.
L’utile netto è più alto; la società non può però pagare perché il debito è già salito. Città, qualità, attività, proprietà, liquidità, già, là, sarà, avrà, potrà, è, né, perché, poiché, finché, cioè, caffè, lunedì, martedì, così, lì, sì, può, però, ciò, andò, pagò, aumentò, virtù, più, giù, Perù. Dell’anno, nell’esercizio, un’azione, all’estero, l’impresa, d’affari, quest’anno.
Spółka zwiększyła przychody, Zarząd zamknął zakład części zamiennych. Należności przeterminowane wyniosły więcej. Rada nadzorcza zebrała się trzy razy w ciągu roku, również dla członków. Zysk, strata, różnice, źródło, źródła, środki, śródroczne, świadczenia, ściśle, żaden, żeby, możliwość, wartość, działalność, jakość, część, wysokość, płynność, należność, są, będą, mogą, ją, tą, drogą, spółką, umową, się, nią, tę, chcę, mogę, pieniądze, wynagrodzenia, państwo, dzień, koniec, końca, ubezpieczeń, zobowiązań, zamówień, był, była, było, były, został, została, zostały, zmniejszył, złoty, złotych, główny, który, która, które, których, wzór, góra, król, ogółem, spółki, spółek, kwartał, udział, kapitał, zespół, łącznie, Łódź, Łukasz, łatwo, ćwierć, zapłacić, wypłacić, przyjąć, zamknąć, zamierza, powyżej, poniżej, też, już, również, sprzedaż, także, każdy, dłużny, pożyczka, dług, długi, krótki, krótkoterminowe, Śląsk, Życie, Żywiec.
Selskabet på Færøerne har også solgt sine færger; året før var støtten større. Øresund, Ærø, Århus, København, Sønderborg, Åbo, Ålesund, Tromsø, Bodø, Malmö, Göteborg, Jönköping, Västerås, Örebro, Åre, Skåne, Småland. Både første og næste år må målet nås. Försäljningen ökade för andra året; bolaget har också höjt målet. Fælles, læse, være, gøre, køb, nød, båd, hård, ønske, øge, ærlig, går, så, når, då, också, från, än, är, när, där, här, åtgärd, även, öppen, större, högre, köp. Þórunn, Ísland, það, við, með, staðið. Yhtiön myynti väheni, mutta käyttökate pysyi hyvällä tasolla.
"""

# Words that tell a language, all ASCII and so the same under every encoding.
FUNCTION_WORDS = {
    "en": "the of and to in was were is are for that by at with on from as our we be will which has have had this its not it",
    "es": "el la los las del que en por con una se su para un al de y lo es como cuando fue sus",
    "pt": "os as da do das dos que em um uma para com no na nos nas por se de foi ao e o pelo pela",
    "fr": "le la les des du et une un est dans sur par aux pour qui que de en au ont sont ce",
    "de": "der die das und den dem des im ist von mit auf ein eine nicht zu wurde zum zur bei sich als",
    "it": "il lo la gli le della di che per sono nel un una del dei con alla da e in non si",
}
_LANGUAGES_OF = {w: tuple(k for k, words in FUNCTION_WORDS.items() if w in words.split()) for words in FUNCTION_WORDS.values() for w in words.split()}
_PLAIN_WORD = re.compile(r"(?<!\w)[A-Za-z]+(?!\w)")
_PRONOUNS = set("i he she it we you they who that there what here let".split())
_CONTRACTED = re.compile(r"(?<!\w)([A-Za-z]+)([^\x00-\x7f’])(s|t|re|ll|ve|d|m)(?!\w)|(?<!\w)([a-z]{3,}s)([^\W\x00-\x7f])(?!\w)")

#: What a contraction needs, quickly told.
_MAYBE_CONTRACTED = re.compile(r"(?<=[A-Za-z])[^\x00-\x7f’“”–—](?:(?:s|t|re|ll|ve|d|m)(?!\w)|(?<=s.)(?!\w))")


def language(text: str) -> str | None:
    """The language most of the function words belong to, if at least two do and no other has as many."""
    hits = dict.fromkeys(FUNCTION_WORDS, 0)
    for w in _PLAIN_WORD.findall(text):
        for k in _LANGUAGES_OF.get(w.lower(), ()):
            hits[k] += 1
    first, second = sorted(hits, key=hits.get, reverse=True)[:2]
    return first if hits[first] >= 2 and hits[first] > hits[second] else None


def contracted(word: str, ending: str) -> bool:
    """Whether an apostrophe may stand between them: names as París and Solís are short and capitalised."""
    if ending == "t":
        return word[-1] in "nN"
    return word.lower() in _PRONOUNS or word.islower() and len(word) > 1 or len(word) >= 4 or len(word) > 1 and word.isupper()


#: How much a neighbour's general frequency counts beside what was seen with the character.
SMOOTH = 3.0
#: What a reading has to gain, in all, to be taken; and a line, once its text is known to be garbled.
LEAST, LEAST_LINE = 4.5, 0.5
#: A place that gains so much under a reading makes a text worth scoring.
HINT = 1.5
#: What a reading gains by an English contraction ("the bankís rate" as "the bank’s rate"): in English, letters beyond ASCII do not stand there.
CONTRACTION = 6.0

# Fixed values: (written, read), the mix-ups that are tried; where two score the same the first is taken.
PAIRS = (
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("iso8859-2", "cp1252"),
    ("mac_roman", "cp850"), ("mac_roman", "cp437"), ("cp850", "mac_roman"), ("cp437", "mac_roman"), ("cp1250", "cp1252"),
)


@lru_cache(maxsize=32)
def reading(written: str, read: str) -> dict[int, str]:
    """For str.translate: what was read, by what was written."""
    table = {}
    for byte in range(0x80, 0x100):
        try:
            seen = bytes([byte]).decode(read)
        except UnicodeDecodeError:
            seen = chr(byte)
        try:
            table[ord(seen)] = bytes([byte]).decode(written)
        except UnicodeDecodeError:
            table[ord(seen)] = "�"
    return table


def _side(c: str) -> str:
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return c.lower()
    if c > "\x7f" and not c.isspace():
        return "~"  # another one in question: no reading may profit from its neighbour's
    return "0" if c.isdigit() else " " if c.isspace() or not c else c


def _letter(before: str, c: str, after: str) -> str:
    """Capitals count as small letters where capitals stand; inside a word of small letters they do not."""
    if c.isupper() and not ("a" <= before <= "z"):
        return c.lower()
    return c


class Model:
    """Counts of characters beyond ASCII and of their neighbours."""

    def __init__(self, text: str):
        places = [(text[k - 1 : k], c, text[k + 1 : k + 2]) for k, c in enumerate(text) if c > "\x7f"]
        folded = [(_side(a), _letter(a, c, b), _side(b)) for a, c, b in places]
        self.n = Counter(c for _, c, _ in folded)
        self.before, self.after = Counter((c, a) for a, c, _ in folded), Counter((c, b) for _, c, b in folded)
        self.total = sum(self.n.values())
        self.sides = (self._spread(a for a, _, _ in folded), self._spread(b for _, _, b in folded))
        self._memo: dict[tuple[str, str, str], float] = {}

    @staticmethod
    def _spread(sides) -> dict[str, float]:
        n = Counter(sides)
        return {s: (k + 1) / (sum(n.values()) + 100) for s, k in n.items()}

    def score(self, before: str, c: str, after: str) -> float:
        """The logarithm of the character and its neighbours."""
        a, x, b = _side(before), _letter(before, c, after), _side(after)
        if (known := self._memo.get((a, x, b))) is not None:
            return known
        n = self.n[x]
        out = math.log((n + 0.05) / (self.total + 20))
        for counts, side, spread in ((self.before, a, self.sides[0]), (self.after, b, self.sides[1])):
            out += math.log((counts[x, side] + SMOOTH * spread.get(side, 0.002)) / (n + SMOOTH))
        if len(self._memo) < 200_000:
            self._memo[a, x, b] = out
        return out


@lru_cache(maxsize=1)
def model() -> Model:
    return Model(SAMPLE)


#: Characters that some reading has another for; all but blanks that the encodings agree on.
_CHARACTERS = "".join(sorted({chr(c) for p in PAIRS for c in reading(*p)}))
_HINT = re.compile(f"[{re.escape(_CHARACTERS)}]")
_PLACE = re.compile(r"[^\x00-\x7f]")
#: What a reading loses by a character that its encoding does not have.
ALIEN = -8.0
#: Lines and sentences, without the white space after them.
_LINES = re.compile(r"[^\n]+?(?:[.!?](?=\s)|(?=\n)|$)", re.S)


def likelihood(text: str) -> float:
    """The score of all characters beyond ASCII."""
    m = model()
    return sum(m.score(text[k - 1 : k] if k else "", p.group(), text[k + 1 : k + 2]) for p in _PLACE.finditer(text) if (k := p.start()) >= 0)


@lru_cache(maxsize=200_000)
def gains(before: str, c: str, after: str) -> tuple[float, ...]:
    """What each of ``PAIRS`` gains at one place over the text as it is."""
    if "─" <= c <= "▟" and not (before.isalnum() or after.isalnum()):
        return (0.0,) * len(PAIRS)  # a drawn table
    m = model()
    now = m.score(before, c, after)
    out = []
    for pair in PAIRS:
        new = reading(*pair).get(ord(c))
        out.append(ALIEN if new is None else m.score(before, new, after) - now)
    return tuple(out)


def _gains_of(text: str, start: int, end: int, english: bool) -> list[float]:
    total = [0.0] * len(PAIRS)
    for p in _PLACE.finditer(text, start, end):
        k = p.start()
        for j, g in enumerate(gains(text[k - 1 : k] if k else "", p.group(), text[k + 1 : k + 2])):
            total[j] += g
    for m in _CONTRACTED.finditer(text, start, end):
        sign = m[2] or m[5]
        if (m[5] or contracted(m[1], m[3])) and (language(text[start:end]) or ("en" if english else "")) == "en":
            for j, pair in enumerate(PAIRS):
                total[j] += CONTRACTION * (reading(*pair).get(ord(sign)) == "’")
    return total


def reread(text: str) -> tuple[str, int]:
    """The text with the lines put right that read better as written in another encoding, and how many they are."""
    contractions = bool(_MAYBE_CONTRACTED.search(text))
    if not contractions and not any(max(gains(text[k - 1 : k] if k else "", c, text[k + 1 : k + 2])) > HINT for k, c in ((p.start(), p.group()) for p in _HINT.finditer(text))):
        return text, 0
    english = contractions and language(text) == "en"
    scored = [(a, b, _gains_of(text, a, b, english)) for a, b in ((m.start(), m.end()) for m in _LINES.finditer(text)) if _HINT.search(text, a, b)]
    sums = [sum(max(0.0, g[j]) for _, _, g in scored) for j in range(len(PAIRS))]
    best = max(range(len(PAIRS)), key=lambda j: (sums[j], -j))
    if sums[best] < LEAST:
        return text, 0
    table = reading(*PAIRS[best])
    out, at, changed = [], 0, 0
    for a, b, g in scored:
        if g[best] > LEAST_LINE:
            out += [text[at:a], text[a:b].translate(table)]
            at, changed = b, changed + 1
    return "".join([*out, text[at:]]), changed

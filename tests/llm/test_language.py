from pyspark.sql import functions as F

from tests.conftest import SF
from weftline.llm import language as L
from weftline.session import table

EN = "The weight of every household was checked against the state total before the release. "
ES = "El peso de cada hogar se compara con el total del estado antes de la última versión. "
DE = "Das Gewicht der Haushalte wird vor der nächsten Fassung mit der Landessumme noch einmal verglichen. "
ZH = "每个住户的权重在发布之前都要与全州总数进行核对。"


def test_posteriors_without_training():
    m = L.letter_model(None)
    texts = [EN, ES.upper(), DE, ZH, EN + ES, None, "", "cd_geoid 2024 | 12 | 13", "A" * 300_000, "." * 200_000 + "x", "\n" * 200_000, "a_" * 200_000]
    out = list(L.posteriors(texts, [None] * len(texts), [None] * len(texts), m, [1 / 7] * 7))
    assert [[L.LANGS[int(p[4].argmax())] for p in d] for d in out[:5]] == [["en"], ["es"], ["de"], ["zh"], ["en", "es"]]
    assert out[5][0][:2] == (0, 0) and abs(out[6][0][4].sum() - 1) < 1e-9


def test_declared_and_host_evidence_decide_when_text_does_not():
    m = L.letter_model(None)
    neutral = [[1 / 7] * 7]
    host = [[0.01, 0.94, 0.01, 0.01, 0.01, 0.01, 0.01]]
    ask = lambda text, dec, pri: L.LANGS[int(next(L.posteriors([text], [dec], pri, m, [1 / 7] * 7))[0][4].argmax())]
    assert ask("12345", "it", neutral) == "it" and ask("12345", None, host) == "es"
    assert ask('<html lang="fr">12345', None, neutral) == "fr"
    assert ask(EN, "it", host) == "en"


def test_labels(spark):
    rows = [("en",), ("en_US",), ("EN",), ("eng",), ("English",), ("español",), ("zh-Hans",), ("pt-BR",), ("mul",), ("und",), ("",), ("en,fr",), ("??",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "l string").select(L.label_language(F.col("l"))).collect()]
    assert got == ["en", "en", "en", "en", "en", "es", "zh", "pt", None, None, None, None, None, None]


def test_held_out_accuracy(spark):
    """Fitted on even ids, the models must agree with the labels of odd ids wherever function words do."""
    docs = table(spark, SF.replace("0.001", "0.01"), "documents")
    m = L.fit(docs.where("doc_id % 2 = 0"))
    right = n = 0
    for r in docs.where("doc_id % 2 = 1").withColumn("d", L.label_language(F.col("lang"))).where("d is not null and d <> 'zh'").collect():
        for _, _, plain, words, p in ((*s[:2], s[2], s[3], None) for s in L.statements(r["text"])):
            if words >= L.MIN_WORDS and L.votes(plain) == r["d"]:
                post = next(L.posteriors([plain], [None], [None], m, [1 / 7] * 7))[0][4]
                right += L.LANGS[int(post.argmax())] == r["d"]
                n += 1
    assert n > 1000 and right / n > 0.995


def test_found_and_edge_cases(spark):
    rows = [(1, EN, "en", "a-x"), (2, EN, "fr", "a-x"), (3, EN + ES, "en", None), (4, DE, None, "b-x"), (5, None, None, None), (6, "", "en", ""), (None, ES, "mul", "a"), (7, ZH, "zh-CN", "a"), (7, ZH, "zh-CN", "a"), (8, "Household weight 2024", "und", "a"), (9, EN * 4000, "EN", "c.com"), (10, ZH + EN, "zh", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit("x") for c in ("label", "prior", "src", "declared", "segment_no", "start", "present", "n")})
    seg = L.segment_documents(df)
    got = {tuple(r) for r in L.wrong_labels(L.document_languages(seg)).collect()}
    assert got == {(2, "en"), (3, "en"), (3, "es"), (4, "de"), (None, "es"), (10, "zh"), (10, "en")}
    assert {r["doc_id"] for r in seg.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None}
    old, L.BROADCAST_SOURCES = L.BROADCAST_SOURCES, 0
    assert {tuple(r) for r in L.wrong_labels(L.document_languages(L.segment_documents(df))).collect()} == got
    L.BROADCAST_SOURCES = old
    assert L.segment_documents(df.where("false")).count() == 0


# Written for these tests, apart from all data: general sentences, two or three a language, held out of any fit.
KNOWN = {
    "en": ["The old bridge was closed for repairs last spring, and drivers had to take the long way around the lake.", "My sister says that she will bring the cake, but nobody has told her what time the party begins."],
    "es": ["El puente viejo estuvo cerrado la primavera pasada y los conductores tuvieron que dar la vuelta por el lago.", "Mi hermana dice que traerá la tarta, pero nadie le ha contado a qué hora empieza la fiesta."],
    "fr": ["Le vieux pont a été fermé pour des travaux au printemps dernier et les conducteurs ont dû faire le tour du lac.", "Ma sœur dit qu'elle apportera le gâteau, mais personne ne lui a dit à quelle heure commence la fête."],
    "de": ["Die alte Brücke war im letzten Frühjahr wegen Bauarbeiten gesperrt, und die Fahrer mussten um den ganzen See herumfahren.", "Meine Schwester sagt, dass sie den Kuchen mitbringt, aber niemand hat ihr gesagt, wann das Fest beginnt."],
    "pt": ["A ponte velha esteve fechada para obras na primavera passada e os condutores tiveram de dar a volta ao lago.", "A minha irmã diz que vai trazer o bolo, mas ninguém lhe disse a que horas começa a festa."],
    "it": ["Il vecchio ponte è rimasto chiuso per lavori la primavera scorsa e gli automobilisti hanno dovuto fare il giro del lago.", "Mia sorella dice che porterà la torta, ma nessuno le ha detto a che ora comincia la festa."],
    "zh": ["去年春天那座旧桥因为维修而关闭，司机们只好绕着湖走远路。", "我姐姐说她会带蛋糕来，可是没有人告诉她聚会几点开始。"],
}
UNKNOWN = [
    "De oude brug was vorig voorjaar dicht voor herstel en de bestuurders moesten helemaal om het meer heen rijden.",
    "Stary most był zamknięty zeszłej wiosny z powodu remontu, a kierowcy musieli jechać dookoła jeziora dłuższą drogą.",
    "Den gamla bron var stängd för reparation i våras och bilisterna fick ta den långa vägen runt sjön.",
    "Podul vechi a fost închis pentru reparații primăvara trecută, iar șoferii au trebuit să ocolească tot lacul pe drum.",
    "Vanha silta oli viime keväänä suljettu korjausten vuoksi, ja autoilijoiden piti kiertää koko järvi pitkää reittiä pitkin kotiin.",
    "Eski köprü geçen bahar onarım için kapalıydı ve sürücüler gölün etrafından uzun yolu kullanmak zorunda kaldılar her gün.",
    "Starý most byl loni na jaře zavřený kvůli opravám a řidiči museli jezdit dlouhou cestou kolem celého jezera.",
    "Den gamle bro var lukket for reparation i foråret, og bilisterne måtte køre den lange vej rundt om søen.",
    "Старый мост был закрыт на ремонт прошлой весной, и водителям приходилось ехать вокруг озера длинной дорогой каждый день.",
    "Η παλιά γέφυρα ήταν κλειστή για επισκευές την περασμένη άνοιξη και οι οδηγοί έκαναν τον γύρο της λίμνης.",
    "古い橋は去年の春に修理のために閉鎖され、運転手は湖をぐるりと回らなければなりませんでした。",
    "오래된 다리는 지난 봄에 수리 때문에 폐쇄되어 운전자들은 호수를 빙 돌아 먼 길로 가야 했습니다 매일 아침마다 그리고 저녁에도.",
]


def test_unseen_languages_are_other_and_known_ones_are_found(spark):
    m = L.fit(table(spark, SF.replace("0.001", "0.01"), "documents"))
    even = [[1 / 7] * 7]
    ask = lambda t, dec=None: next(L.posteriors([t], [dec], even, m, [1 / 7] * 7))[0][4]
    for t in UNKNOWN:
        for dec in (None, "en", "de", "zh"):
            p = ask(t, dec)
            assert L.ALL[int(p.argmax())] == L.OTHER or p.max() < 0.5, (t, dec, p.round(3))
    said = [(c, L.ALL[int((p := ask(t)).argmax())], p.max()) for c, ts in KNOWN.items() for t in ts]
    sure = [(c, got) for c, got, p in said if p >= L.SURE]
    assert all(c == got for c, got in sure) and len(sure) >= 0.9 * len(said)
    assert L.ALL[int(ask("Вес 12", "zh").argmax())] == L.OTHER


def test_markup_declares_the_language_of_its_element():
    m = L.letter_model(None)
    text = '<div lang="fr"><p lang="it">1234. </p> 567856785678. <br lang="es"/><div>9.</div> 10.</div> <p>777777.</p>'
    at, langs = L.declared_elements(text)
    spot = lambda s: langs[L.bisect_right(at, text.index(s)) - 1]
    assert [spot(s) for s in ("1234", "5678", "9.<", " 10.", "777")] == ["it", "fr", "fr", "fr", None]
    parts = next(L.posteriors([text], [None], [[1 / 7] * 7], m, [1 / 7] * 7))
    got = {text[s:e].strip(): L.ALL[int(p.argmax())] for s, e, _, _, p in parts}
    assert [v for k, v in got.items() if "5678" in k] == ["fr"]
    for long in ('<p lang="fr">' * 50_000 + "</q>" * 50_000, "<a>" * 100_000 + ' lang="', '<p lang="x' * 50_000, '<p title="' + "y" * 1_000 + '" lang="de">Haus'):
        L.declared_elements(long)
    assert L.declared_elements('<p title="' + "y" * 1_000 + '" lang="de">Haus')[1][-1] == "de"


def test_other_is_never_a_found_language(spark):
    m = [(1, UNKNOWN[0], "en", "a"), (2, EN + UNKNOWN[8], "en", "a"), (3, UNKNOWN[8], "ru", "a")]
    seg = L.segment_documents(spark.createDataFrame(m, "doc_id long, text string, lang string, source string"))
    langs = L.document_languages(seg)
    assert {tuple(r) for r in L.wrong_labels(langs).collect()} == {(2, "en")}
    assert {r["doc_id"]: r["lang"] for r in langs.collect()}[3] == L.OTHER

"""The operators against brute-force versions, exact round trips and held-out rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import chat, common, decontamination, html, language, neardup, packing, quality, queries, scoring, tokens, toxicity
from shelfwise.session import materialize

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [*"aB  SsIißéé\n\t\r\x0b\x0c\x1c\x1f\x85\xa0sdt12<|>_-K", *map(chr, (0x3A3, 0x3C2, 0x130, 0x2028, 0x3000, 0x200B, 0xB2, 0x663, 0x915, 0x94D, 0x6F22, 0x1F600, 0x1C5, 0x17F, 0x212A, 0xFB01, 0, 0xFEFF, 0x301)),
       "<|endoftext|>", "<|startoftext|>", "'ll", "'RE"]


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in common.table(spark, SF, "documents").collect()}


def read(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", tokens.TokenCounter), ("byte_bpe_50k.json", tokens.TokenCounter), ("byte_bpe_50k.json", tokens.ByteLevelEncoder)])
def test_tokens_are_the_library_s(texts, name, kind):
    library, own = Tokenizer.from_file(public_tokenizers.path(name)), kind(read(name))
    random.seed(7)
    odd = ["".join(random.choices(ODD, k=random.randint(0, 14))) for _ in range(3000)]
    for text in [*(t or "" for t in texts.values()), *odd, "ab" * 5000]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert (own.encode(text) == ids) if kind is tokens.ByteLevelEncoder else (own.count(text) == len(ids)), repr(text[:80])


def test_token_query(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in queries.op3_token_counts(spark, SF).collect():
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def brute_components(sets, percent=80):
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def shingles(text, size=4):
    words = SPACED.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_near_duplicates_query(spark, texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    expected = brute_components(sets)
    for r in queries.op2_near_duplicates(spark, SF).collect():
        d = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[d]), expected[d], expected[d] == d)


def test_near_duplicates_in_groups(spark):
    """Chains, groups of near copies with an untypical smallest id, texts at and just below the threshold, small sets."""
    random.seed(3)
    word = lambda: "".join(random.choices("abcdefgh", k=6))
    docs = []
    for _ in range(6):
        base = [word() for _ in range(random.choice((6, 24, 120, 400)))]
        for _ in range(40):
            copy = list(base)
            for _ in range(random.choice((0, 1, 1, 2, 3, 5, 8))):
                copy[random.randrange(len(copy))] = word()
            docs.append((len(docs), " ".join(copy).upper()))
        chain = list(base)
        for _ in range(10):
            chain = [*chain[len(chain) // 12 :], *(word() for _ in range(len(chain) // 12))]
            docs.append((len(docs), " ".join(chain)))
    docs += [(len(docs) + k, " ".join(map(str, range(n)))) for k, n in enumerate((1, 2, 3, 4, 5, 7, 8, 9))]
    expected = brute_components({d: shingles(t) for d, t in docs})
    found = neardup.link_copies(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_registers_are_ordered_and_estimate():
    random_ = np.random.default_rng(5)
    a, other = random_.integers(0, 2**64 - 1, 4000, dtype=np.uint64), random_.integers(0, 2**64 - 1, 800, dtype=np.uint64)
    b = np.concatenate([a[:3200], other])
    one, two = (neardup.registers(x, np.zeros(len(x), np.int64), 1) for x in (a, b))
    value, used = neardup.estimates(one, two, np.array([4000]), np.array([4000]))
    assert used[0] == 128 and abs(value[0] - 3200 / 4800) < 0.2
    least = min(int(h) >> neardup.REGISTER_BITS for h in a if int(h) % 128 == 5)
    length = least.bit_length()
    assert one[0, 5] >> neardup.MANTISSA_BITS == length
    assert one[0, 5] & ((1 << neardup.MANTISSA_BITS) - 1) == (least >> (length - 1 - neardup.MANTISSA_BITS)) & ((1 << neardup.MANTISSA_BITS) - 1)


def test_decontamination_query(spark, texts):
    import hashlib

    items = {r["item_id"]: ALNUM.findall((r["text"] or "").translate(LOWER)) for r in common.table(spark, SF, "benchmark").collect()}
    windows = defaultdict(set)
    for item, words in items.items():
        for i in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[i : i + 13])].add(str(item))
    sizes = {len(w) for w in windows}
    some = 0
    for r in queries.op6_decontamination(spark, SF).collect():
        words = ALNUM.findall((texts[r["doc_id"]] or "").translate(LOWER))
        hit, named = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    named |= own
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (len(words), len(hit), len(named), digest)
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(words))
        some += r["contaminated"]
    assert some


def test_longest_match_and_its_place():
    tests = decontamination.prepare_tests(["7", "8"], ["a b c d e f g h i j k l m n o p", "short item"], 13)
    found = decontamination.match_shard(pa.array(["x A,b c d e f g h i j k l m n q", "a b c", "not a short item!"]), tests, 13)
    assert found[0][1:] == ([{"begin": 1, "end": 15}], ["7"], 14, 1, "7")
    assert found[1][1] == [] and found[2][1:] == ([{"begin": 2, "end": 4}], ["8"], 2, 2, "8")


def test_packing_query(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = queries.op8_best_fit_packing(spark, SF).collect()
    ids = {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(own.tobytes())
    for d, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1].tolist()]
        assert sum(r["length"] for r in own) == len(ids[d]) and all(r["length"] == 1024 for r in own[1:])
    assert set(by_doc) == set(ids)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1].tolist()]
        assert sum(r["length"] for r in own) <= 1024
    assert len(by_sequence) <= -(-sum(r["length"] for r in found) // 1024) * 1.05 + 1


def test_packing_plan_uses_every_piece():
    random.seed(2)
    for histogram in ({}, {1024: 7}, {600: 100}, {512: 3, 511: 5, 1: 1}, {random.randint(1, 1024): random.randint(1, 500) for _ in range(200)}):
        plan = packing.packing_plan(histogram, 1024)
        used = defaultdict(int)
        for pattern, repeats in plan:
            assert sum(pattern) <= 1024 and repeats > 0
            for n in pattern:
                used[n] += repeats
        assert used == histogram


def test_quality_query(spark, texts):
    for r in queries.op7_quality_rules(spark, SF).collect():
        text = texts[r["doc_id"]] or ""
        words = SPACED.findall(text)
        windows = defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i : i + 5])].append(i)
        covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_ablations_follow_from_the_ledger(spark):
    ledger = quality.rule_ledger(common.table(spark, SF, "documents"))
    failed = [r["failed"] for r in ledger.select("failed").collect()]
    for r in quality.ablations(ledger).collect():
        bit, rest = quality.bits((r["rule"],)), quality.bits(quality.POLICIES[quality.PRODUCTION]) & ~quality.bits((r["rule"],))
        assert r["n_failed"] == sum(bool(f & bit) for f in failed)
        assert r["n_kept_without"] == sum(not f & rest for f in failed)


def test_toxicity_automaton_equals_edit_distance():
    def distance(a, b):
        """Insertions, deletions, replacements and swaps of neighbours, each place edited once."""
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    row[-1] = min(row[-1], rows[-2][j - 2] + 1)
            rows.append(row)
        return rows[-1][-1]

    terms = [toxicity.Term(t, s) for t, s in (("idiot", False), ("idiom", False), ("scum", False), ("worthless", False), ("lowei", True), ("bad", True), ("kloo", True))]
    automaton = toxicity.LexiconAutomaton(terms)
    random.seed(1)
    words = ["idiot", "idoit", "idi0t", "idiots", "scumm", "lowe", "loweiss", "lovei", "badly", "bd", "", "scm", "wrothless", "wurthles", "owrthlses", "loewi", "loewiss"]
    words += ["".join(random.choices("idotmscuwrhlebav", k=random.randint(1, 9))) for _ in range(3000)]
    for t in terms:
        for _ in range(200):
            w = list(t.text)
            for _ in range(random.randint(0, 2)):
                w[random.randrange(len(w))] = random.choice(["", "a", "xy", "o"])
                if random.random() < 0.5:
                    k = random.randrange(len(w) - 1)
                    w[k], w[k + 1] = w[k + 1], w[k]
            words.append("".join(w))
    for word in words:
        expected = {}
        for k, t in enumerate(terms):
            best = min(distance(word[:i], t.text) for i in range(len(word) + 1)) if t.stem else distance(word, t.text)
            if best <= t.edits:
                expected[k] = best
        assert dict(automaton.match(word)) == expected, word


def test_toxicity_tells_quoting_from_abuse():
    model = toxicity.ToxicityModel([toxicity.Term("idiot", False, (6.0, 2.0, 0.0))], (-4.0, 1.0, 0.4, 0.0, 0.0))
    automaton = toxicity.LexiconAutomaton(model.terms)
    score = lambda text: model.score(*toxicity.find_hits(automaton, text))
    assert score("You are such an idiot and you know it") > 0.7 > score('The report said the word "idiot" was used twice')
    assert score("a fine day") < score("what an idiiot he is") < score("what an idiot he is")


def test_toxicity_catches_misspellings(spark):
    """One edit from four letters on, two from eight, swaps of neighbours as one; a hit at each distance weighs what it is seen to say."""
    fine = [(f"w{i} a fine day for some of you now w{i} there", False) for i in range(60)]
    abuse = [(f"w{i} you {w} of {v} now w{i}", True) for i, (w, v) in enumerate([("scum", "idiot"), ("worthless", "scum"), ("idiot", "worthless")] * 12)]
    slips = [(f"w{i} you {w} there w{i}", True) for i, w in enumerate(["idoit", "scumm", "wrothless", "wurthles", "scm", "idiott"])]
    model = toxicity.learn_model(spark.createDataFrame([*fine, *abuse, *slips], "text string, toxic boolean"))
    assert {t.text[:4] for t in model.terms} == {"scum", "idio", "wort"}, model.terms
    automaton = toxicity.LexiconAutomaton(model.terms)
    score = lambda w: model.score(*toxicity.find_hits(automaton, f"well you {w} over there"))
    for word in ("idoit", "iidiot", "scumm", "scm", "wrothless", "wurthles", "worhtlses", "scmu"):
        assert score(word) > 0.5 > score("friend"), (word, model.terms)


def test_window_weights_are_fitted(spark):
    """Where address goes with quoting in the labels, its weight turns round; without quotations weights stay where they start."""
    term = [toxicity.Term("idiot", False, (6.0, 2.0, 0.0))]
    rows = [({(0, 0, 4): 1}, 9, 0)] * 40 + [({(0, 0, 0): 1}, 9, 1)] * 40 + [({(0, 0, 1): 1}, 9, 0)] * 20
    marks, reports, address = toxicity.fit_window(rows, term)
    assert address > 0.7 and marks > 1.5 and reports == pytest.approx(0.7)
    assert toxicity.fit_window([], term) == toxicity.WINDOW_PRIOR


def test_toxicity_learns_from_like_texts_but_not_from_copies(spark):
    """The same two neighbours in every text; texts apart from each other count, copies don't."""
    fine = [(f"w{i} a fine day w{i}", False) for i in range(60)]
    learnt = lambda texts: {t.text for t in toxicity.learn_model(spark.createDataFrame([*fine, *((t, True) for t in texts)], "text string, toxic boolean")).terms}
    assert "zorgle" in learnt([f"w{i} you zorgle now w{i}" for i in range(30)])
    assert not learnt(["you zorgle now", "You  ZORGLE now!"] * 15)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op4_toxicity(spark, sf).filter("held_out").join(common.table(spark, sf, "labels"), "doc_id").select("predicted", "toxic").toPandas()
    hit = ((found["predicted"] == 1) & (found["toxic"] == 1)).sum()
    assert hit / (found["predicted"] == 1).sum() > 0.9 and hit / (found["toxic"] == 1).sum() > 0.75


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op9_language_id(spark, sf).join(common.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    for _, own in found.groupby("held_out"):
        assert (own["lang_pred"] == own["lang"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_language_models_are_distributions(spark):
    texts = ["the quick brown fox", "der schnelle braune fuchs", "the dog"]
    sample = spark.createDataFrame([("en", texts[0]), ("de", texts[1]), ("en", texts[2])], "lang string, text string")
    model = language.learn_model(sample)
    signs = sorted({*"".join(texts)} | {" "})
    for before in ("the", "xyz", "hne"):
        means = np.array([language.mean_chances(model, [before + s])[0] * (len(before) + 1) - language.mean_chances(model, [before])[0] * len(before) for s in signs])
        assert (np.exp(means).sum(0) < 1.0001).all() and (np.exp(means).sum(0) > 0.8).all()


def test_scores_equal_a_plain_count(spark, texts):
    """Few buckets, so that collisions are many and must be the same."""
    bits, docs = 10, common.table(spark, SF, "documents")
    labels = common.table(spark, SF, "labels").filter("quality = 1")
    target = {r["doc_id"] for r in labels.collect()}
    grams = {}
    for d, t in texts.items():
        words = common.words_of(pa.array([t]), common.SPACED)
        one, two, _ = scoring.grams_of(words, bits)
        grams[d] = list(zip(one.tolist(), two.tolist(), scoring.contexts_of(words, bits).tolist()))
    counts = [[np.zeros(1 << bits) for _ in range(3)] for _ in range(2)]
    for d, own in grams.items():
        for g in own:
            for k in range(3):
                counts[1][k][g[k]] += 1
                counts[0][k][g[k]] += d in target
    for r in scoring.cross_entropy_difference(docs, labels, bits=bits).collect():
        own = grams[r["doc_id"]]
        assert r["n_words"] == len(own)
        mine = [defaultdict(int) for _ in range(3)]
        for g in own:
            for k in range(3):
                mine[k][g[k]] += 1
        for model, loss in ((0, r["target_loss"]), (1, r["background_loss"])):
            inside = model == 1 or r["doc_id"] in target
            total = counts[model][0].sum() - inside * len(own)
            value = 0.0
            for g in own:
                a, b, c = (counts[model][k][g[k]] - inside * mine[k][g[k]] for k in range(3))
                p = (a + scoring.ADDED) / (total + scoring.ADDED * (1 << bits))
                value -= np.log(scoring.MIXTURE * min(b / c if c > 0 else p, 1) + (1 - scoring.MIXTURE) * p)
            assert (loss is None and not own) or abs(loss - value / len(own)) < 1e-9


def test_html_query_and_other_layouts(spark):
    pages = common.table(spark, "/root/testdata/sf0.01", "pages")
    field = html.learn_field(pages)
    page = """<html><head><title>T</title><script>x="</p>"</script></head><body><header><h2>Site</h2></header><ul class=menu><li><a href=/>Home</a></ul>
    <div class="cookie-notice">We use cookies.</div><main><header><h1>Head &amp; line</h1></header><p>First   <b>bold
    text</b>.<br>More&nbsp;text<p>Second paragraph, &eacute;.<form><label>Mail</label><input></form><aside>Related: <a href=x>this</a></aside>
    <p>Third.</p></main><section id="comments"><p>Nice post!</p></section><div class=sidebar>Popular</div><footer>&copy; us</footer></body></html>"""
    assert html.main_text(field, page) == "Head & line\nFirst bold text. More text\nSecond paragraph, é.\nThird."
    named = re.compile(r"<article>(.*)</article>", re.S)
    import html as entities

    for r in pages.join(html.extract(pages, field).select("page_id", "text"), "page_id").collect():
        blocks = re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", named.search(r["html"])[1])
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in blocks if b)


ARTICLE = ["Head of it", "First paragraph of the article, with a stop.", "Energy is E=mc2 here, and fallback text.", "Last words of the article end here."]
INNER = """<h1>Head of it</h1><p>First paragraph of the <b>article</b>, with a stop.</p>
<p>Energy is <math><mi>E</mi><mo>=</mo><mi>mc</mi><mn>2</mn></math> here, and <object data=x>fallback text</object>.</p><p>Last words of the article end here.</p>"""
AROUND = '<nav><a href=/>Home</a></nav><div class="ad">Buy this now, it is good.</div>', '<div id="comments"><p>What a nice post that was, thanks.</p></div><div class="sidebar">Popular</div><footer>&copy; us</footer>'


@pytest.mark.parametrize("trained", [True, False])
@pytest.mark.parametrize("wrap", [
    "<body class='has-sidebar'>{0}<article>%s</article>{1}</body>", "<body class='has-sidebar comments'>{0}<div class='content with-sidebar'><article>%s</article></div>{1}",
    "<body>{0}<div id='sidebar-page' class='comments-open'><main>%s</main></div>{1}", "<html class='no-ads'><body>{0}<form class='search'><article>%s</article></form>{1}",
    "<body>{0}<article><header class='entry-header'><p>Head of it</p></header>%s<section class='comments'><p>What a fine text this is, I say.</p></section></article>{1}",
    "<body>{0}<article>%s</article><div id='comments'><article class='comment'><p>What a nice post that was, thanks.</p></article></div>{1}",
])
def test_no_word_of_an_article_is_lost(spark, wrap, trained):
    field = html.learn_field(common.table(spark, SF, "pages")) if trained else html.PRIOR
    page = wrap.format(*AROUND) % (INNER if "entry-header" not in wrap else INNER.replace("<h1>Head of it</h1>", ""))
    assert html.main_text(field, f"<html><head><title>T</title></head>{page}").split("\n") == ARTICLE


@pytest.mark.parametrize("wrap", ["<body>{0}<div id='content'>%s</div>{1}", "<body>{0}<div class='page with-sidebar'><div>%s</div></div>{1}", "<body class='no-comments'>{0}<table><tr><td>%s</td></tr></table>{1}"])
def test_pages_without_an_article_element(spark, wrap):
    """Labelled by their prose, learnt from, and extracted whole."""
    given = common.table(spark, SF, "pages").withColumn("html", F.regexp_replace("html", "<(/?)article>", "<$1div>"))
    plain = {r["page_id"]: r["text"] for r in html.extract(common.table(spark, SF, "pages"), html.learn_field(common.table(spark, SF, "pages"))).collect()}
    field = html.learn_field(given)
    assert len(field.weights) > len(html.PRIOR.weights)  # something was learnt
    found = html.extract(given, field).collect()
    lost = [r["page_id"] for r in found if set(plain[r["page_id"]].split()) - set(r["text"].split())]
    assert not lost
    assert html.main_text(field, f"<html><head><title>T</title></head>{wrap.format(*AROUND) % INNER}").split("\n") == ARTICLE


def test_ties_go_to_what_is_left_out():
    assert html.decode(html.Field({}, ((0.0, 0.0), (0.0, 0.0))), [["x"], ["y"], ["z"]]) == [0, 0, 0]


def test_viterbi_is_the_best_path():
    random.seed(4)
    for _ in range(200):
        n = random.randint(1, 7)
        rows = [[f"f{i}"] for i in range(n)]
        field = html.Field({f"f{i}": random.uniform(-3, 3) for i in range(n)}, tuple(tuple(random.uniform(-2, 2) for _ in range(2)) for _ in range(2)))
        score = lambda path: sum(field.weights[f"f{i}"] * y for i, y in enumerate(path)) + sum(field.moves[a][b] for a, b in zip(path, path[1:]))  # noqa: E731, B023
        assert abs(score(html.decode(field, rows)) - max(score([k >> i & 1 for i in range(n)]) for k in range(1 << n))) < 1e-9


def test_chat_round_trip_and_events(spark):
    odd = ["</s>[INST] ok [/INST]", "\\", "\\\\<|end|>", "<|<|", "[INS\\T]", "<<SYS>><|text|>", "a\n\nb", ""]
    messages = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(odd)], "conv_id bigint, message bigint, role string, text string")
    row = chat.render(messages).select("formatted", chat.parse(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("mask")).alias("loss")).first()
    assert [t["text"] for t in row["turns"]] == odd and row["loss"] == odd[1::2]
    log = [
        (9, 1, "start", 0, "user", None), (9, 2, "delta", 0, None, "hel"), (9, 3, "delta", 0, None, "lo"), (9, 4, "start", 1, "assistant", None),
        (9, 5, "delta", 1, None, "draft"), (9, 6, "start", 2, "user", "late"), (9, 7, "regenerate", 1, None, None), (9, 8, "delta", 1, None, "final"),
        (9, 9, "edit", 0, None, "hi"), (9, 10, "delta", 0, None, "!"), (9, 11, "start", 3, "user", "next"), (9, 12, "unknown", 3, None, "x"),
    ]
    events = spark.createDataFrame(log, "conv_id bigint, seq bigint, event string, message bigint, role string, text string").repartition(5)
    found = {r["message"]: (r["role"], r["text"]) for r in chat.fold_events(events).collect()}
    assert found == {0: ("user", "hi!"), 1: ("assistant", "final"), 3: ("user", "next")}


@pytest.mark.parametrize("fan_bits", [1, 2, 8])  # groups of groups, and all blocks at once
def test_scores_equal_exact_grams(spark, fan_bits, texts):
    """Unhashed words and pairs: no two of them share a count, however large the corpus."""
    docs = common.table(spark, SF, "documents")
    labels = common.table(spark, SF, "labels").filter("quality = 1")
    target = {r["doc_id"] for r in labels.collect()}
    grams = {}
    for d, t in texts.items():
        words = SPACED.findall((t or "").translate(LOWER))
        grams[d] = list(zip(words, zip([None, *words], words), [None, *words]))
    counts = [[Counter(g[k] for d, own in grams.items() if m or d in target for g in own) for k in range(3)] for m in (0, 1)]
    size, sums = len(counts[1][0]), [sum(c[0].values()) for c in counts]
    assert len(counts[1][1]) > size
    found = scoring.cross_entropy_difference(docs, labels, block_bytes=20_000, fan_bits=fan_bits).collect()  # many blocks
    assert len(found) == len(texts)
    for r in found:
        own = grams[r["doc_id"]]
        assert r["n_words"] == len(own)
        mine = [Counter(g[k] for g in own) for k in range(3)]
        for model, loss in ((0, r["target_loss"]), (1, r["background_loss"])):
            inside = model == 1 or r["doc_id"] in target
            value = 0.0
            for g in own:
                a, b, c = (counts[model][k][g[k]] - inside * mine[k][g[k]] for k in range(3))
                p = (a + scoring.ADDED) / (sums[model] - inside * len(own) + scoring.ADDED * size)
                value -= np.log(scoring.MIXTURE * min(b / c if c > 0 else p, 1) + (1 - scoring.MIXTURE) * p)
            assert (loss is None and not own) or abs(loss - value / len(own)) < 1e-9


def test_cells_a_block_do_not_grow_with_the_corpus(spark):
    """Four times the blocks: four times the cells in every exchange, and no larger group of cells."""
    draw = np.random.default_rng(4)
    texts = [(i, " ".join(["the", *(f"w{int(x)}" for x in draw.zipf(1.3, 150) % 5000)])) for i in range(640)]

    def measured(n):
        rows = spark.createDataFrame(texts[:n], "doc_id bigint, text string").repartition(4)
        blocks = materialize(scoring.text_blocks(rows, rows.filter("doc_id % 5 = 0"), "doc_id", "text", 2000), "blocks")
        number = blocks.count()
        groups = -(-number >> 3)
        cells = materialize(scoring.block_cells(blocks, 64, groups, 3), "cells")
        answers = scoring.answer_cells(cells, 64, groups, 3, 8).filter("sender >= 0").count()
        largest = cells.groupBy("grp", "slot").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0]
        return number, cells.count(), answers, largest

    (few, cells, answers, largest), (many, more_cells, more_answers, larger) = measured(160), measured(640)
    assert many > 3.5 * few > 100
    assert answers == cells <= 16 * few and more_answers == more_cells <= 16 * many
    assert larger < 2.5 * largest


@pytest.mark.parametrize("outsiders", [1, 30])
def test_an_outsider_meets_each_block_of_a_linked_group_once(spark, outsiders):
    """Rows of members laid out grow with the group, not with its square; every pair of different components still meets."""

    def laid_out(n):
        rows = [(i, 50, 7, 0) for i in range(n)] + [(10**6 + i, 50, 7, 10**6 + i) for i in range(outsiders)] + [(i, 50, 8, 0) for i in range(n)]
        members, met = neardup.bucket_meetings(spark.createDataFrame(rows, "id bigint, n bigint, token bigint, component bigint"))
        assert members.filter("token = 8").count() == 0  # all linked: nothing to compare
        sides = met.select("token", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
        together = members.join(sides, ["token", "block"]).cache()
        one, two = (together.select("low", "high", F.col("id").alias(k), F.col("component").alias(f"c{k}")) for k in "ab")
        pairs = one.join(two, ["low", "high"]).filter("ca < cb").select("a", "b").distinct().count()
        assert pairs == n * outsiders + outsiders * (outsiders - 1) // 2
        return together.count()

    few, many = laid_out(1000), laid_out(4000)
    assert few < 3 * 1000 + 100 * outsiders and many < 4.6 * few


def test_long_chains_settle(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in neardup.components(edges).collect()} == {0}


def test_a_large_test_set_reads_the_documents_once(spark):
    docs, benchmark = common.table(spark, SF, "documents"), common.table(spark, SF, "benchmark")
    one, several = (decontamination.find_contamination(docs, benchmark, block_chars=n) for n in (10**7, 5000))
    assert sorted(map(str, one.collect())) == sorted(map(str, several.collect()))
    plan = several._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert several.filter("contaminated").count() > 0


def test_language_models_equal_a_plain_kneser_ney(spark):
    """Interpolated Kneser-Ney by dictionaries, character by character, on texts that are and are not learnt from."""
    draw = random.Random(8)
    learnt = {lang: [" ".join("".join(draw.choices(signs, k=draw.randint(1, 7))) for _ in range(40)) for _ in range(6)] for lang, signs in (("aa", "abcdeé"), ("bb", "cdefgh"))}
    rows = spark.createDataFrame([(lang, t) for lang, texts in learnt.items() for t in texts], "lang string, text string")
    model = language.learn_model(rows)
    n, signs = language.ORDER, {c for texts in learnt.values() for t in texts for c in " " + t}
    floor = 1 / (len(signs) + 1)

    def plain(texts):
        grams = [Counter() for _ in range(n + 1)]
        for t in texts:
            t = " " * (n - 1) + t
            grams[n].update(t[i : i + n] for i in range(len(t) - n + 1))
        for k in range(n - 1, 0, -1):  # how many signs each shorter one follows
            grams[k].update(g[1:] for g in grams[k + 1])
        totals, kinds = ([Counter() for _ in range(n + 1)] for _ in range(2))
        for k in range(1, n + 1):
            for g, c in grams[k].items():
                totals[k][g[:-1]] += c
                kinds[k][g[:-1]] += 1

        def chance(g):
            lower = chance(g[1:]) if len(g) > 1 else floor
            k, before = len(g), g[:-1]
            if not totals[k][before]:
                return lower
            return (max(grams[k][g] - language.DISCOUNT, 0) + language.DISCOUNT * kinds[k][before] * lower) / totals[k][before]

        return chance

    asked = [learnt["aa"][0], learnt["bb"][3], "abc fgh", "zz", "a", "é g"]
    found, _, _ = language.mean_chances(model, asked)
    for column, lang in enumerate(model.languages):
        chance = plain(learnt[lang])
        for t, row in zip(asked, found):
            padded = " " * (n - 1) + t
            expected = np.mean([np.log(chance(padded[i : i + n])) for i in range(len(t))])
            assert row[column] == pytest.approx(expected, abs=2e-5), (lang, t)

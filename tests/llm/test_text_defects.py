"""Problems 1, 4, 5 and 9 on made-up cases."""

from __future__ import annotations

import random

import pytest

from citeloom.llm import language, pairs, pii, templates, truncation

# --- cut texts --------------------------------------------------------------------------------------

SENTENCES = ["这款茶的保质期是{}个月，开封后要放在阴凉处。", "有{}位受访者提到口感温和这一点，也有人更看重含量。", "Staff suggest halving the first serving and waiting {} days before going on.", "The listed price is {} dollars, although shops differ a lot."]
GEO = "answer_id string, text string, store string, lengths string, level string, gram string"


def corpus(n=400, seed=1, sentences=SENTENCES):
    rng = random.Random(seed)
    return ["\n".join(rng.choice(sentences).format(rng.randint(10, 99)) for _ in range(rng.randint(2, 6))) for _ in range(n)]


def geo(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], GEO)


@pytest.mark.parametrize("limit", [0, 300_000])
def test_cut_texts_are_found_whole_ones_left(spark, monkeypatch, limit):
    monkeypatch.setattr(truncation, "BROADCAST_PHRASES", limit)
    rng = random.Random(4)
    whole = corpus()
    rows = [(f"w{i}", t, "a") for i, t in enumerate(whole)]
    cut = {}
    for i, t in enumerate(whole[:60]):
        at = rng.randint(12, len(t) - 3)
        piece = t[:at]
        if piece.rstrip()[-1:] not in "。.！" and t[at : at + 1] not in "。.\n" and "\n" not in piece[-2:]:
            cut[f"c{i}"] = piece
    items = [(f"l{i}", f"{t}\n- 保留购买凭证", "a") for i, t in enumerate(whole[60:80])]
    odd = [("n1", None, "a"), ("n2", "", "a"), ("n3", " \n", None), (None, "这款茶的保", "a"), ("s1", "可以", "a"), ("s2", "可以", "a"), ("t1", "| a | b |\n|---|---|\n| 1 | 2 |", "a"), ("t2", "| a | b |\n|---|---|\n| 1", "a"), ("f1", '```json\n{"a": 1', "a"), ("f2", '```json\n{"a": 1}\n```', "a"), ("e1", "茶很好&nbs", "a"), ("u1", "茶很好，这一点�", "a"), ("z", "很长" * 60_000 + "。", "a")]
    rows += [(k, v, "a") for k, v in cut.items()] + items + odd
    got = {r.row_id for r in truncation.find_truncated(geo(spark, [*rows, *rows[:30]]), "answer_id", "text", ["store"]).collect()}
    assert {"t2", "f1", "e1", "u1"} <= got and not got & {"n1", "n2", "n3", "s1", "s2", "t1", "f2", "z"}
    assert not [i for i in got if i[0] in "wl"]
    assert len(got & set(cut)) >= 0.95 * len(cut)


def test_copies_do_not_clear_one_another(spark):
    whole = [(f"w{i}", t, "a") for i, t in enumerate(corpus())]
    copies = [("one", "请大家都记得把这盒新茶要放在", "a")] * 4 + [(f"k{i}", "问过店员以后才知道，也有人" + " " * (i % 3), "a") for i in range(200)]
    got = {r.row_id for r in truncation.find_truncated(geo(spark, whole + copies), "answer_id", "text", ["store"]).collect()}
    assert got == {"one", *(f"k{i}" for i in range(200))}


def test_hidden_limits_under_several_encodings(spark):
    rng = random.Random(6)
    long = ["".join(rng.choice(SENTENCES[:2]).format(rng.randint(10, 99)) for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows = [(f"b{i}", t.encode()[:300].decode(errors="ignore"), "bytes") for i, t in enumerate(long)] + [(f"c{i}", t[:90], "chars") for i, t in enumerate(long)] + [(f"f{i}", t, "free") for i, t in enumerate(long)]
    found = {(r.store, r.measure): r.limit_length for r in truncation.hidden_limits(geo(spark, rows), ["store"], "text").collect()}
    assert found["bytes", "utf8"] == 300 and found["chars", "characters"] == 90 and not [k for k in found if k[0] == "free"]
    got = {r.row_id: r.at_limit for r in truncation.find_truncated(geo(spark, rows), "answer_id", "text", ["store"]).collect()}
    want = {i for i, t, s in rows if s != "free" and t[-1] != "。" and len(t) < len(long[int(i[1:])])}
    assert len(want & set(got)) >= 0.98 * len(want) and len(set(got) - want) <= 0.02 * len(want) and any(got.values())


def test_a_limit_below_the_greatest_length(spark):
    rng = random.Random(7)
    long = ["".join(rng.choice(SENTENCES[:2]).format(rng.randint(10, 99)) for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows = [(f"c{i}", t[:90], "a") for i, t in enumerate(long)] + [("uncut", "茶" * 400 + "。", "a")]
    rows += [(f"k{i}", "一" * 40 + "不", "copies") for i in range(50)] + [("l", "茶" * 400 + "。", "copies")] + [(f"f{i}", t, "free") for i, t in enumerate(long)]
    found = {(r.store, r.limit_length) for r in truncation.hidden_limits(geo(spark, rows), ["store"], "text").where("measure = 'characters'").collect()}
    assert found == {("a", 90)}
    marked = [("m", long[0][:87].rstrip("。") .ljust(87, "茶") + "...", "a")]
    got = {r.row_id: r.at_limit for r in truncation.find_truncated(geo(spark, rows + marked), "answer_id", "text", ["store"]).collect()}
    assert got["m"] and all(v for k, v in got.items() if k[0] == "c")


def test_cut_shares_and_empty_tables(spark):
    df = geo(spark, [("a", "茶&nbs", "s"), ("a", "茶&nbs", "s"), ("b", "茶。", "s"), ("c", None, None)])
    found = truncation.find_truncated(df, "answer_id", "text", ["store"])
    got = {r.store: (r.answers, r.cut_answers, r.cut_share) for r in truncation.truncation_shares(df, found, ["store"], "answer_id").collect()}
    assert got == {"s": (2, 1, 0.5), None: (1, 0, 0.0)}
    assert truncation.find_truncated(geo(spark, []), "answer_id", "text").count() == 0


# --- template residue ---------------------------------------------------------------------------------

QA = "turn_id string, question string, answer string, kind string, page string, mode string"


def qa(spark, rows):
    return spark.createDataFrame([(i, q, a, "k", "p", "quick") for i, q, a in rows], QA)


def test_residue(spark):
    rows = [(f"n{i}", "哪个好？", f"公开资料显示，{b}的茶标价为{i}元。") for i, b in enumerate(["甲记", "乙坊", "丙堂", "丁集"] * 5)]
    bad = {
        "p1": "公开资料显示，{{brand_name}}的茶标价为9元。", "p2": "公开资料显示，【请填写品牌名称】的茶标价为9元。", "p3": "#city#", "p4": "Lorem ipsum dolor sit amet", "p5": "503 Service Unavailable", "p6": "请启用 JavaScript 并刷新本页", "p7": "茶很好。\nSession expired. Log in again to view this answer.",
        "p8": '{"code": 404, "message": "Not Found"}', "p9": "Dolum sitar ipsu morbis tesqua velit congue ornatu nullar.", "p10": "TODO：补结论", "p11": "Traceback (most recent call last):\n  File \"a.py\", line 1\nKeyError: 'x'", "p12": "系统开小差了，请刷新重试。",
    }
    rows += [(k, "哪个好？", v) for k, v in bad.items()]
    good = [
        ("g1", "怎么在邮件模板里写品牌占位符？", "在模板里写成 {{brand_name}} 这样的双花括号即可，发送时系统会换掉。"), ("g2", "为什么官网打开显示 404？", "返回 404 说明该页面已经移走。可以从首页重新进入。"), ("g3", "它的页面为什么提示要启用 JavaScript？", "因为商品页靠脚本渲染价格。打开脚本后刷新即可。"),
        ("g4", "接口返回什么格式？", '例如 {"brand": "demo", "price": 39}。'), ("g5", "哪个好？", "```json\n{\"a\": \"{{x}}\"}\n```\n茶很好。"), ("g6", "404元左右的茶哪个好？", "标价为404元。"), ("g7", None, None), ("g8", "q", ""), ("g9", "q", " "), (None, "q", "#city#"), ("g10", "哪个好？", "很好" * 40_000),
    ]
    got = {r.row_id for r in templates.template_residue(qa(spark, [*rows, *good, *rows[-3:]])).collect()}
    assert got == set(bad)
    assert templates.template_residue(qa(spark, [])).count() == 0


def test_a_constant_string_is_no_slot(spark):
    rows = [(f"c{i}", "这怎么写？", "Put ${price} where the amount should appear in it.") for i in range(4)] + [("x", "q", "Tea costs ${price} in the shop.")] + [(f"y{i}", "q", f"Tea costs {w} in the shop.") for i, w in enumerate(["nine", "ten", "six"])]
    assert {r.row_id for r in templates.template_residue(qa(spark, rows)).collect()} == {"x"}


def test_a_template_broken_in_every_record(spark):
    rows = [(f"d{i}", "Was my order sent?", f"Dear {{{{customer_name}}}}, your order was sent on day {i}.") for i in range(6)] + [(f"t{i}", "怎么写模板？", "开头写 {{customer_name}} 即可。") for i in range(4)]
    rows += [(f"c{i}", "q", "Use `{{customer_name}}` there.") for i in range(4)]
    assert {r.row_id for r in templates.template_residue(qa(spark, rows)).collect()} == {f"d{i}" for i in range(6)}


@pytest.mark.parametrize("limit", [0, 1000])
def test_slots_by_either_lookup(spark, monkeypatch, limit):
    monkeypatch.setattr(templates, "BROADCAST_CONTEXTS", limit)
    rows = [(f"n{i}", "q", f"The price of {w} tea is fine today.") for i, w in enumerate(["red", "green", "blue"])] + [("p", "q", "The price of {{colour}} tea is fine today.")] + [(f"c{i}", "q", "Type %name% here.") for i in range(4)]
    assert {r.row_id for r in templates.template_residue(qa(spark, rows)).collect()} == {"p"}


def test_clean_rows_stay(spark):
    df = qa(spark, [("a", "q", "#city#"), ("b", "q", "茶。"), (None, "q", "茶。")])
    left = templates.is_residue_free(df, templates.template_residue(df))
    assert {r.turn_id for r in left.collect()} == {"b", None}


# --- pairs --------------------------------------------------------------------------------------------


def test_defects(spark):
    q = "云记的茶靠谱吗？请查阅公开网页后作答，附上出处。"
    fine = [(f"w{i}", q, t) for i, t in enumerate(corpus(120, 3, SENTENCES[:2]))]
    bad = {
        "e1": ("empty", None), "e2": ("empty", "&nbsp;"), "e3": ("empty", "N/A"), "e4": ("empty", "..."), "e5": ("empty", "​"), "r1": ("refusal", "抱歉，这个问题我不便回答。您可以问我其他方面的内容。"), "r2": ("refusal", "I'm sorry, but I am not able to comment on specific brands."),
        "c1": ("copy", "云记的茶靠谱吗"), "c2": ("copy", "您是想问“云记的茶靠谱吗？”，对吗"), "c3": ("copy", q + "\n" + q), "l1": ("wrong_language", "Staff suggest halving the first serving and waiting for the answer of the shop. The price is the same as it was before."), "t1": ("truncated", "这款茶的保质期是12个月，开封后要放在阴凉处。这款茶的保质期是&nbs"),
    }
    good = [
        ("g1", q, "可以"), ("g2", q, "有用户抱怨客服总说“这个问题我不便回答”，后来才得到解释。这款茶的保质期是12个月，开封后要放在阴凉处。"), ("g3", "请用英文回答：云记的茶靠谱吗？", "Staff suggest halving the first serving and waiting for the answer of the shop."), ("g4", q, q + "\n有30位受访者提到口感温和这一点，也有人更看重含量。"),
        ("g5", None, "这款茶的保质期是12个月，开封后要放在阴凉处。"), ("g6", q, "#city#"), (None, q, None), ("g7", q, "有30位受访者提到口感温和这一点，也有人更看重含量。\n英文标签原文：“When asked why they chose it, most people said it was on the shelf.”"),
    ]
    rows = [*fine, *((k, q, a) for k, (_, a) in bad.items()), *good]
    got = {r.row_id: r.defect_type for r in pairs.pair_defects(qa(spark, [*rows, *rows[-9:]])).collect()}
    assert got == {k: d for k, (d, _) in bad.items()}
    assert pairs.pair_defects(qa(spark, [])).count() == 0


def test_the_field_learns_from_labels():
    rows = [("哪个好？", t, False) for t in corpus(60, 8, SENTENCES[:2])] + [("哪个好？", "抱歉，我不能就这一话题提供信息。请换个问题试试。", False)] * 20
    trained = pairs.training_set(rows)
    w, t = pairs.fit(trained)
    held = pairs.training_set([("哪种茶好？", s, False) for s in corpus(40, 9, SENTENCES[:2])])
    right = sum((pairs.decode(x, w, t) == y).sum() for x, y in held)
    assert right / sum(len(y) for _, y in held) > 0.95
    nothing = pairs.fit([])
    assert (nothing[0] == pairs.prior()[0]).all()


@pytest.mark.parametrize(
    ("text", "lang"),
    [("这款茶很好，可以买。", "zh"), ("全体として穏やかです。", "ja"), ("The price of the tea is the same as before.", "en"), ("Der Preis liegt bei neun Euro und ist nicht hoch.", "de"), ("Le prix affiché est de neuf euros avec un écart.", "fr"), ("El precio es de nueve euros con una diferencia.", "es"), ("12345", None), ("", None), ("Norara", None)],
)
def test_languages(text, lang):
    assert language.language(text) == lang


# --- personal information -------------------------------------------------------------------------------

FOUND = [
    ("发邮件到anna.b+shop@mail.test，谢谢", {"email"}), ("写信到anna (at) mail[dot]test", {"email"}), ("anna at mail dot test", {"email"}), ("ANNA＠MAIL.TEST", {"email"}), ("аnna@mail.test", {"email"}), ("an​na@mail.test", {"email"}), ("电话154-0825-5623。", {"phone"}), ("退款请打幺五四七三二二七九零九找我", {"phone"}), ("回电１５４９９７２８３９４", {"phone"}), ("(0200) 8729 8798 转 201", {"phone"}),
    ("call me on +44 (0)20 7946 0899 after six", {"phone"}), ("Text 200.555.0132", {"phone"}), ("one five four seven three two two seven nine zero nine", {"phone"}), ("unter +49 30 23125 741.", {"phone"}), ("le +33 6 39 98 84 13.", {"phone"}), ("es 500 319 103.", {"phone"}), ("身份证号904115199511249367已经提交", {"id_number"}), ("９０７４５５２００００４０１８８４２，请核对", {"id_number"}), ("E 0093 0443", {"id_number"}), ("asked for 906-48-8476, which", {"id_number"}), ("QQ 39 90 41 C", {"id_number"}),
    ("Mi DNI es 99.545.585-K.", {"id_number"}), ("Steuer-ID lautet 02990963131.", {"id_number"}), ("sécurité sociale : 2 20 13 00 932 182 86", {"id_number"}), ("寄到柳河市东桥区白鹭大道88号4栋3单元402室。", {"address"}), ("住在青渡镇石桥村五组10号", {"address"}), ("to Flat 24, 54 Quince Drive, Ashvale.", {"address"}), ("an Lindenhofstraße 148.", {"address"}), ("Am Weiher 131a, 00668 Talbrück.", {"address"}), ("au 94 bis, avenue du Moulin Bas.", {"address"}), ("en C/ Chopo Alto 134, 18.º B.", {"address"}),
    ("我叫尉迟栩珩，住在这里", {"name"}), ("尊敬的陆翊澄先生，您好", {"name"}), ("Dear Mr Yselle Carnberg, we", {"name"}), ("Kind regards,\nBrandova, Elowen", {"name"}), ("Me llamo Runa Holloberg y", {"name"}), ("此致\n沈朔", {"name"}),
    ("订单号 688718199001017214，下单", set()), ("观看量 15436460472 次", set()), ("产品批号 154038096587", set()), ("条码 6990631076342 扫不出来", set()), ("Batch no. 154-6015-483 passed", set()), ("Section 932.60-8212 covers", set()), ("The ratio moved from 200:555 to 210:554.", set()), ("scraper@1.6.3 已升级", set()), ("店铺账号@ixoundo_live 昨天", set()), ("Most shops on Harlow Lane closed early.", set()), ("梧桐路一带的门店", set()),
    ("see https://a.test/p/15436460472", set()), ("Im Jahr 2004 verglich die Stelle 54 Proben.", set()), ("Kind regards,", set()), ("2024年5月6日", set()),
]


@pytest.mark.parametrize(("text", "kinds"), FOUND)
def test_findings(text, kinds):
    assert {k for k, _, _ in pii.find_pii(text)} == kinds


def test_spans_map_back_to_the_source(spark):
    text = "你好\r\n写信到an​na (at) mail[dot]test，或打幺五四七三二二七九零九\n我叫沈朔。"
    assert [text[a:b] for _, a, b in pii.find_pii(text)] == ["an​na (at) mail[dot]test", "幺五四七三二二七九零九", "沈朔"]
    assert pii.redact_text(text) == "你好\r\n写信到[EMAIL]，或打[PHONE]\n我叫[NAME]。"
    long = "茶" * 300_000 + "\n电话15448028053。"
    rows = [(1, text, 0), (2, None, 0), (3, "", 0), (4, " ", 0), (5, long, 0), (5, long, 0), (None, "电话15448028053。", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, line_no int")
    got = {(r.doc_id, r.line_no, r.pii_type) for r in pii.find_in(df).collect()}
    assert got == {(1, 2, "email"), (1, 2, "phone"), (1, 3, "name"), (5, 2, "phone"), (None, 1, "phone")}
    clean = {r.doc_id: r.t for r in df.select("doc_id", pii.redact("text").alias("t")).distinct().collect()}
    assert clean[2] is None and clean[3] == "" and clean[5].endswith("\n电话[PHONE]。") and len(clean[5]) > 300_000
    assert pii.find_in(df.limit(0)).count() == 0

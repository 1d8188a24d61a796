"""Residue, boilerplate and lines repeated within a site."""

import random
from collections import defaultdict

import pytest

from newsquarry.llm import boilerplate, residue
from newsquarry.llm.boilerplate import find_furniture, furniture_lines, line_ratios, main_lines, smooth, threshold
from newsquarry.llm.residue import TemplateTree, classify, find_residue, has_open_slot, mine_templates, verdict
from newsquarry.llm.site_lines import Summary, line_key, repeated_lines, without_lines

REPORT = "Hôm qua, công ty bị phạt 3 tỷ đồng vì xả thải ra sông.\nNgười dân nói gì\nChúng tôi sẽ theo dõi tiếp vụ việc này trong tuần."
OPEN = ["Công ty {{ ten }} bị phạt.", "Bị phạt ${so_tien} đồng.", "Theo #{x} nói.", "Số {0} người.", "<%= a %> nói", "Ngày {% d %} qua", "Ở [[noi]] có", "Do %%LEAD%% làm", "Do @@item.x@@ làm", "Ông __ten__ nói", "Giá $gia$ đồng", "Bà *|TEN|* nói", "Tăng undefined undefined đồng", "Giảm [object Object] lần", "Thu NaN tỷ", "Theo <TÊN TÁC GIẢ> cho biết", "Tại [NGÀY THÁNG] có mưa"]
CLOSED = ["Vay $703 triệu, lãi <3% mỗi năm.", "Kết luận [12] dẫn [Phụ lục 5] và bảng <26>.", "Ký hiệu %% trong bảng.", "[ADVERTISEMENT]", "[TRANG CHỦ] [ĐỜI SỐNG]", "[Ảnh] Cá chết", "* [ĐÌNH CHỈ MẢNG BAO BÌ](https://a.vn/b-1.html)", "Tập {1; 2}", "email a@b.vn", "giá trị rỗng"]
BAD = ["404 Not Found\nGo back | Home | Search", "You need to enable JavaScript to run this app.", "Công ty A - Kinh doanh\nYêu cầu của bạn đã bị chặn bởi hệ thống bảo vệ. ID phiên: 23.657", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "test test test 83", "HỆ THỐNG ĐANG BẢO TRÌ, MỜI QUÝ ĐỘC GIẢ QUAY LẠI SAU 52 PHÚT.", "asdf asdf qwer 8 Nội dung đang được cập nhật."]
GOOD = [REPORT, REPORT + "\nHệ thống bán hàng báo lỗi 404 suốt 8 giờ.", 'Báo cáo còn sót đoạn "lorem ipsum" ở trang 3, kế toán trưởng thừa nhận.', "Trang tra cứu báo \"Access denied\" khi phóng viên nhập mã hồ sơ.\n" + REPORT, "Người dùng được yêu cầu bật JavaScript mới xem được bảng giá.\n" + REPORT]


@pytest.mark.parametrize("text", OPEN)
def test_open_slots(text):
    assert has_open_slot(text)


@pytest.mark.parametrize("text", CLOSED)
def test_no_slots(text):
    assert not has_open_slot(text)


@pytest.mark.parametrize("text", BAD)
def test_residue(text):
    assert verdict(text) not in ("", "slot")


@pytest.mark.parametrize("text", GOOD)
def test_reports(text):
    assert verdict(text) == ""


# wordings no list of cues may lose
PROBES = ["400 Bad Request", "401 Unauthorized", "Hãy bật mã kịch bản để xem", "Vui lòng xác nhận bạn không phải người máy", "Không xuất bản", "Biên tập viên nhập nội dung", "This takes about 5 seconds", "Đoạn văn bản để trống", "The requested URL was not found on this server.", "404", "Máy chủ quá tải, mời thử lại.", "Lorem ipsum dolor sit amet. " * 300, "\n".join(f'File "a{i}.py", line {i}, in render' for i in range(80))]


@pytest.mark.parametrize("text", PROBES)
def test_seeds_alone(text):
    assert verdict(text) not in ("", "slot")


def test_tree_merges_alike_messages():
    t = TemplateTree()
    texts = [f"Lỗi {n}: Trang bạn tìm không tồn tại ở máy m{n}" for n in range(5)] + ["Lỗi 3: Trang bạn cần không tồn tại ở máy m3"]
    assert {t.add(residue.tokens_of(x)) for x in texts} == {0}
    ((_, tokens),) = t.templates().items()
    assert tokens.count("<*>") == 3 and classify(" ".join(tokens)) == "error"
    assert t.add(["x"]) == 1 and t.add([]) == 2 and [t.add(residue.tokens_of(f"a{chr(97 + i)} b c d")) for i in range(9)] == list(range(3, 12))


def test_class_of_a_template():
    seeds = lambda **k: [k.get(c, 0) for c in residue.CLASSES]
    assert residue._class_of(4, 0, 99, 0, seeds(error=2)) == "error" and residue._class_of(5, 0, 99, 0, seeds(error=2)) == ""
    assert residue._class_of(5, 4, 99, 0, seeds()) == "aside" and residue._class_of(2, 2, 9, 9, seeds()) == ""
    assert residue._class_of(5, 0, 30, 3, seeds()) == "stock" and residue._class_of(5, 0, 31, 3, seeds()) == residue._class_of(5, 0, 30, 2, seeds()) == residue._class_of(4, 0, 30, 3, seeds()) == ""


def test_find_residue_and_mining(spark):
    rows = [(str(i), b, "x") for i, b in enumerate([*BAD, *GOOD, *OPEN, None, "", " \n "])] + [("0", BAD[0], "y"), (None, BAD[0], "z"), ("big", REPORT * 3000, "q")]
    df = spark.createDataFrame(rows, "k string, b string, class string")
    want = {str(i) for i in range(len(BAD))} | {str(len(BAD) + len(GOOD) + i) for i in range(len(OPEN))} | {None}
    assert {r.k for r in find_residue(df, "k", "b").collect()} == want
    assert {r["class"] for r in mine_templates(df, "k", "b").collect()} >= {"script", "error", "block", "filler", "maintenance"}
    assert find_residue(df.limit(0), "k", "b").count() == 0 and mine_templates(df.limit(0), "k", "b").count() == 0


def test_templates_decide_where_no_seed_does(spark, monkeypatch):
    unknown = [(f"u{i}", f"Quý khách chờ giây lát {w}, mã {i}", f"site{i % 4}.vn") for i, w in enumerate(["nhé", "nha", "ạ", "nhé", "nhé", "nha"])]
    mixed = [(f"m{i}", "Please turn on javascript before reading this page now", "a.vn") for i in range(5)] + [("m5", "Please turn on jscript before reading this page now", "a.vn")]
    beside = [(f"b{i}", f"404 Not Found\nMáy phục vụ số hiệu S{i} thuộc cụm Bắc, ngày nghỉ.", "a.vn") for i in range(4)]
    local = [(f"l{i}", f"Cửa hàng mở cửa lúc {i} giờ", "one.vn") for i in range(9)]  # one site only
    flash = [(f"r{i}", REPORT + f" Tin này có {i} phần." + " Đoàn kiểm tra làm việc tới khuya và niêm phong ba cửa xả." * 3, f"s{i}.vn") for i in range(6)]  # longer texts that are republished
    df = spark.createDataFrame(unknown + mixed + beside + local + flash, "k string, b string, domain string")
    found = {r.k: r["class"] for r in find_residue(df, "k", "b", "domain").collect()}
    assert found == {**{k: "stock" for k, _, _ in unknown}, **{k: "script" for k, _, _ in mixed}, **{k: "error" for k, _, _ in beside}}
    assert not any(verdict(b) for _, b, _ in unknown) and verdict(mixed[-1][1]) == "" and verdict(beside[0][1]) == ""
    monkeypatch.setattr(residue, "SIMILARITY", 1.1)  # without the tree every wording stands for itself
    apart = residue.TemplateTree()
    assert len({apart.add(residue.tokens_of(b)) for _, b, _ in unknown}) == 6
    assert len({residue.TemplateTree(similarity=0.6).add(residue.tokens_of(b)) for _, b, _ in unknown}) == 1


# long, of sentences that differ, and but for one line page furniture, so no residue by its length or its repeats
LONG_ERROR = "404 Not Found\nTin liên quan\n" + "\n".join(f"• {i}{w} bị phạt vì xả thải ra sông Cái lần thứ {i}" for i, w in enumerate(("Tavoco Drimex Fadeco Hazeco Kelora Rimoda Bokasa Cevito Rakovi Uvitra Zuvina Mocnha " * 2).split()))


def test_all_messages_of_long_bodies_are_mined(spark):
    assert len(LONG_ERROR) > 900 and verdict(LONG_ERROR) == "error"
    long = "\n".join([REPORT, *(f"Ý {'abcdefghijklmnopqrst'[i]} của đoàn kiểm tra nói về cửa xả thứ {i} và cách xử lý." for i in range(18))])
    flash = [(f"f{i}", "Giá gạo hôm nay đứng yên.", f"s{i % 4}.vn") for i in range(6)]
    in_reports = [(f"r{i}", f"{long}\nGiá gạo hôm nay đứng yên.", f"s{i}.vn") for i in range(2)]
    df = spark.createDataFrame([("e", LONG_ERROR, "a.vn"), *flash, *in_reports], "k string, b string, domain string")
    assert len(long) > 900
    n = {r.template: r.n for r in mine_templates(df, "k", "b", "domain").collect()}
    assert n["giá gạo hôm nay đứng yên."] == 8 and n["người dân nói gì"] == 2
    # what stands in reports too is no stock message, so the short bodies are no residue
    assert {r.k: r["class"] for r in find_residue(df, "k", "b", "domain").collect()} == {"e": "error"}
    assert {r.k for r in find_residue(df.where("k < 'r'"), "k", "b", "domain").collect()} == {"e", *(k for k, _, _ in flash)}
    assert {r.k for r in find_furniture(df, "k", "b", "domain").collect()}.isdisjoint({"e"})


def test_a_long_report_that_mentions_an_error_gives_no_company(spark):
    rest = [f"{w} người dân ở hạ lưu kể lại việc cá chết hàng loạt sau đêm mưa lớn." for w in ("Ba", "Bốn", "Năm", "Sáu", "Bảy", "Tám", "Chín", "Mười", "Trăm", "Ngàn", "Vạn", "Triệu", "Tỷ", "Vài")]
    report = "\n".join([*rest, "Lỗi hệ thống khiến trạm đo không gửi được số liệu."])
    df = spark.createDataFrame([(f"k{i}", f"{report}\nSố {i} ghi nhận.", f"s{i}.vn") for i in range(5)], "k string, b string, domain string")
    assert len(report) > 900 and find_residue(df, "k", "b", "domain").count() == 0


def test_one_split_serves_messages_and_words(monkeypatch):
    text = "Menu: Trang chủ | Home\n Giá 10.000đ tăng!  Lỗi 404…Không. Hết?\tΟΔΟΣ x² 3\n\nİSTANBUL. \u2028 Chờ"
    seen = []
    monkeypatch.setattr(residue, "_tokens", residue.Remembered(lambda t: seen.append(t) or residue._token(t), 100))
    own = []
    found = residue.page_messages(text, [0], text.lower(), own)
    assert found == residue.page_messages(text, [0]) and sorted(seen) == sorted(set(text.lower().split()))
    assert own == text.lower().split("\n", 1)[1].split()
    assert [m[:3] for m in found] == [(0, 0, 1), *((1, i, 4) for i in range(4)), (3, 0, 2), (3, 1, 2)]
    assert [m[4] for m in found][1:5] == ["giá <*> tăng!", "lỗi <*>", "hết?", "οδος <*> <*>"]


def test_wildcards_take_in_no_other_messages():
    t = TemplateTree()
    reports = ["tại dây chuyền cán thép chỉ chạy 9 giờ mỗi ngày.", "tại dịch vụ cảng cạn chỉ chạy 9 giờ mỗi ngày.", "tại tổ hợp phân bón chỉ chạy 9 tiếng mỗi ngày.", "tại tổ hợp phân bón chỉ chạy 9 giờ mỗi ngày!", "ở đội tàu ven bờ chỉ chạy 9 giờ mỗi ngày."]
    joined = {t.add(residue.tokens_of(f"hệ thống lọc {x}")) for x in reports}
    assert len(joined) < len(reports) and t.add(residue.tokens_of("hệ thống đang bảo trì, mời quý độc giả quay lại sau 9 phút.")) not in joined


def test_leaves_passed_over_hold_no_class(spark, monkeypatch):
    bodies = [*BAD, *GOOD, LONG_ERROR, *(f"Quý khách chờ giây lát {w}, mã 1" for w in ("nhé", "nha", "ạ")), *(f"404 Not Found\nMáy phục vụ số hiệu S{i} ngày nghỉ." for i in range(4))]
    rows = [(f"{i}-{j}", b, f"s{j}.vn") for i, b in enumerate(bodies) for j in range(3)]
    df = spark.createDataFrame(rows + rows[:9], "k string, b string, domain string")
    some = sorted(map(tuple, find_residue(df, "k", "b", "domain").collect()))
    monkeypatch.setattr(residue, "LEAF_BUCKETS", 1)  # all leaves together, so none is passed over
    assert some == sorted(map(tuple, find_residue(df, "k", "b", "domain").collect())) and len(some) > 20
    monkeypatch.setattr(residue, "MAX_IDS", 0)  # repeated rows are joined
    assert some == sorted(map(tuple, find_residue(df, "k", "b", "domain").collect()))


def test_near_duplicates_leave_out_what_is_residue(spark, tmp_path):
    from newsquarry.llm import queries

    # the second message has a class by the template of the first only
    bodies = ["Your request was blocked by the firewall error", "Your request was stopped by the firewall error"]
    rows = [(f"{i}-{j}", b, "a.vn") for i, b in enumerate([*bodies, REPORT, REPORT + " Thêm."]) for j in range(2)]
    spark.createDataFrame(rows, "article_id string, body string, domain string").write.parquet(f"{tmp_path}/articles.parquet")
    residue_ids = {r.article_id for r in queries.QUERIES["p3_found"](spark, str(tmp_path)).collect()}
    near = {x for r in queries.QUERIES["p4_found"](spark, str(tmp_path)).collect() for x in tuple(r)[:2]}
    assert residue_ids == {"0-0", "0-1", "1-0", "1-1"} and near == {"2-0", "2-1", "3-0", "3-1"}


PAGE = """Trang chủ

Ảnh

Bạn đang ở: Pháp đình / Đối thoại

Hàng tồn của công ty tăng 55,5% trong quý này.

Người dân nói gì

- Khoản phải trả tại cảng: 464 tỷ đồng.

Bài viết có 61 lượt đọc, hãy gửi cho bạn bè.

"Chúng tôi sẽ khắc phục", giám đốc nói.

Tin liên quan:

Pexira chậm trả thẻ thành viên cho 498 người

* [Đình chỉ trang trại gió](https://a.vn/b-1.html)

3. Vụ sạt taluy ở phường Đồng Gáo: 2 người nhập viện

Bài học cho đơn vị khác

Tin liên quan tới khoản đặt cọc mua đất lan nhanh trên các diễn đàn.

We use cookies để đo lượt đọc. Accept all

Bình luận : chưa có ý kiến nào

© 2024 Báo X. Giấy phép số 1."""


def test_page():
    lines = PAGE.split("\n")
    want = [i for i, x in enumerate(lines) if x.startswith(("Trang chủ", "Ảnh", "Bạn đang", "Bài viết", "Tin liên quan:", "Pexira", "* [", "3. Vụ", "We use", "Bình luận", "©"))]
    assert furniture_lines(PAGE) == want
    assert main_lines(PAGE)[:2] == ["Hàng tồn của công ty tăng 55,5% trong quý này.", "Người dân nói gì"]


def test_parser_events_and_smoothing():
    assert line_ratios(["<div><a>x</a></div>", "", "Một câu dài của báo."])[1] is None
    assert line_ratios(["<ul><li><a href=x>Tin</a></li></ul>"])[0] < 4 < line_ratios(["Một câu dài của báo."])[0]
    assert line_ratios(["<![CDATA[ <!x", "a"]) and furniture_lines("") == [] and furniture_lines("\n \n") == []
    assert smooth([2.0] * 5) == pytest.approx([2.0] * 5) and 1 < threshold([1.0, 1.1, 5.0, 5.2]) < 5 and threshold([3.0, 3.0]) < 3


HTML_PAGE = [
    ("<ul class=\"menu\">", True), ("<li><a href=\"/\">Trang chu</a></li>", True), ("<li><a href=\"/kinh-te\">Kinh te va doanh nghiep</a></li>", True), ("<li><a href=\"/x\" class=\"b\">Moi truong song</a></li> <li><a href=\"/y\">Lao dong viec lam</a></li>", True), ("</ul>", True),
    ("<h1>Nhà máy xả thải ra sông, dân kêu cứu</h1>", False),
    ("<p>Công ty đã xả nước thải chưa xử lý ra sông trong nhiều tháng, theo biên bản của đoàn kiểm tra liên ngành.</p>", False),
    ("<p>Ông H. nói.</p>", False),
    ("<p>Đoàn kiểm tra do <a href=\"/so\">Sở Môi trường</a> lập đã lấy mẫu ở ba điểm xả, kết quả vượt ngưỡng cho phép nhiều lần.</p>", False),
    ("<h2>Hậu quả rất nặng nề</h2>", False),
    ("<p><a href=\"/kl\">Kết luận kiểm tra dài bốn mươi trang đã được công bố.</a></p>", False),
    ("<p>Người dân hai xã ven sông cho biết cá chết hàng loạt, nước giếng đổi màu và có mùi khó chịu suốt mùa khô.</p>", False),
    ("<div><a href=\"/a\">Gia thep tang</a> <a href=\"/b\">Lu ve som</a> <a href=\"/c\">Cang moi mo</a></div>", True),
    ("<div><a href=\"/d\">Dieu khoan dung</a> <a href=\"/e\">Lien he toa soan</a></div>", True),
]


def test_html_page():
    found = set(furniture_lines("\n".join(x for x, _ in HTML_PAGE)))
    assert [i in found for i in range(len(HTML_PAGE))] == [y for _, y in HTML_PAGE]
    report = [x for x, y in HTML_PAGE if not y and "Ông" not in x]
    assert furniture_lines("\n".join(report)) == []


MENU = "Đăng nhập\nLiên hệ toà soạn\nFollow us on Facebook\nPrivacy Policy\nThời sự\nKinh tế\nHôm qua, công ty bị phạt 3 tỷ đồng vì xả thải ra sông, theo biên bản của đoàn kiểm tra liên ngành.\nNgười dân nói gì\nChúng tôi sẽ theo dõi tiếp vụ việc này trong tuần, đại diện xã cho biết hôm nay.\nĐiều khoản sử dụng\nSơ đồ trang\nỨng dụng di động\nRSS\nLiên hệ quảng cáo"


def test_ratios_decide_where_no_phrase_does(monkeypatch):
    assert furniture_lines(MENU) == [0, 1, 2, 3, 4, 5, 9, 10, 11, 12, 13]
    assert furniture_lines("\n".join(MENU.split("\n")[:6])) == list(range(6))  # no text at all
    figures = "Kết quả đo như sau, theo biên bản của đoàn kiểm tra liên ngành hôm qua.\n- Hồ A: 5 mg/l\n- Hồ B: 6 mg/l\n- Hồ C: 7 mg/l\nCác mẫu còn lại sẽ có kết quả trong tuần tới, đại diện sở cho biết."
    assert furniture_lines(figures) == []
    # a long item among short ones: what is around it decides, so without smoothing it would stay
    item = MENU.replace("Ứng dụng di động", "Ứng dụng di động và chỉ dẫn cho người đọc mới")
    assert furniture_lines(item) == furniture_lines(MENU)
    monkeypatch.setattr(boilerplate, "smooth", lambda values, sigma=1.0: values)
    assert furniture_lines(item) == [x for x in furniture_lines(MENU) if x != 11]


def test_stock_lines_of_a_site_are_furniture(spark):
    body = lambda i: f"Công ty {'ABCD'[i]} bị phạt vì xả thải ra sông trong nhiều tháng.\nBản tin do nhóm trực đêm thực hiện, liên hệ số {i}."
    df = spark.createDataFrame([(f"a{i}", body(i), "WWW.a.vn" if i % 2 else "a.vn") for i in range(4)] + [(f"b{i}", body(i), "b.vn") for i in range(3)] + [("n", body(1), None)], "article_id string, body string, domain string")
    got = sorted((r.article_id, r.line_no) for r in find_furniture(df, "article_id", "body", "domain").collect())
    assert got == [(f"a{i}", 1) for i in range(4)] and find_furniture(df, "article_id", "body").count() == 0


def test_find_furniture(spark):
    df = spark.createDataFrame([("a", PAGE, 1), ("a", PAGE, 2), ("b", None, 3), ("c", "", 4), (None, "© 2024 X", 5), ("d", "Câu. " * 50_000, 6), ("e", BAD[0], 7)], "article_id string, body string, k int")
    got = [(r.article_id, r.line_no) for r in find_furniture(df, "article_id", "body").collect()]
    assert sorted(x for k, x in got if k == "a") == furniture_lines(PAGE) and len(got) == len(set(got))
    assert {k for k, _ in got} == {"a", None}
    assert find_furniture(df.limit(0), "article_id", "body").count() == 0


def brute(rows, least=4, share=20):
    docs, holds = defaultdict(set), defaultdict(set)
    for k, d, b in rows:
        if k is None or not d or not d.strip() or not b or not b.strip():
            continue
        s = d.strip().lower()
        s = s[4:] if s.startswith("www.") else s
        docs[s].add(k)
        for i, x in enumerate(b.split("\n")):
            if x.strip():
                holds[s, line_key(x)].add((k, i))
    out = set()
    for (s, _), v in holds.items():
        n = len({k for k, _ in v})
        if n >= least and n * share >= len(docs[s]):
            out |= v
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeated_lines_equal_counting(spark, seed, monkeypatch):
    r = random.Random(seed)
    stock = [f"Dòng cố định {c}" for c in "abcdefghij"]
    rows = []
    for i in range(400):
        site = r.choice(["big.vn", "WWW.big.vn", "Big.VN", "s1.vn", "s2.vn", None, " "])
        lines = [f"câu riêng {''.join(r.choices('xyzuvw', k=9))}" for _ in range(4)] + [x.upper() if r.random() < 0.2 else f"  {x} {r.randrange(99)}" for x in r.sample(stock, k=r.randrange(3))] + [""]
        r.shuffle(lines)
        rows.append((f"d{i}" if i % 50 else None, site, "\n".join(lines) if i % 37 else r.choice([None, "", " \n"])))
    rows += rows[:30]
    df = spark.createDataFrame([(*x, "z", 1) for x in rows], "id string, domain string, body string, site string, k int")
    got = repeated_lines(df, "id", "domain", "body")
    assert {(x.id, x.line_no) for x in got.collect()} == brute(rows)
    clean = without_lines(df.select("id", "body"), "id", "body", got)
    assert clean.count() == len(rows) and clean.where("body LIKE '%cố định%'").count() < df.where("body LIKE '%cố định%'").count()
    import newsquarry.llm.site_lines as m

    monkeypatch.setattr(m, "MAX_CANDIDATES", 1)  # candidates joined instead of broadcast
    assert {(x.id, x.line_no) for x in repeated_lines(df, "id", "domain", "body").collect()} == brute(rows)
    assert repeated_lines(df.limit(0), "id", "domain", "body").count() == 0


def test_summary_error_is_bounded():
    r = random.Random(2)
    s, true = Summary(), defaultdict(int)
    for _ in range(3000):
        keys = {min(int(r.expovariate(0.05)), 400) for _ in range(6)}
        for k in keys:
            true[k] += 1
        s.add(keys)
        s.shrink(s.size(0.05))
    assert s.error <= 0.05 * s.rows
    assert all(true[k] - s.error <= s.counts.get(k, 0) <= true[k] for k in true)


@pytest.mark.parametrize("line", ["Từ khóa: Zuvina, Bizulo, bên lề", "Từ khoá: a", "TỪ KHÓA: A, B", "PV  nhóm Điều tra - Đất Mẹ", "Biên tập: Ban Kinh tế X | Trình bày: Tổ Ảnh", "Xem  bản in X số 3 tại các sạp gần nhà.", "X giữ bản quyền ảnh và chữ, mọi sao chép cần chấp thuận.", "Thảo luận (12)", "Trao đổi , vui lòng gõ tiếng Việt có dấu", "Mọi tấm lòng hảo tâm qua tòa soạn, mã số 83935.", "Bạn đọc ủng hộ xin gửi về quỹ sẻ chia, mã số 1.", "Về X • Tuyển dụng • Sơ đồ trang • RSS", "Cơ quan chủ quản: Hội X | Điều khoản | Chính sách riêng tư", "TẠP CHÍ X - Đường dây nóng: 0000 750 918 - Liên hệ quảng cáo", "[ADVERTISEMENT]", "Cookie giúp trang chạy ổn hơn, để ghi nhớ phiên. Manage"])
def test_furniture_line(line):
    assert furniture_lines(f"Một câu của báo hôm nay.\n{line}\nMột câu khác của báo.") == [1]


@pytest.mark.parametrize("line", ["Bạn đọc ủng hộ quyết định của xã.", "Trang chủ của đội tàu vẫn quảng cáo dự án đã bị đình chỉ.", "Công ty bị nhắc vì thu thập cookie của 12 khách hàng.", "Khách phải đăng nhập 3 lần mới nộp được đơn.", "Đường dây nóng của công ty nhận 501 cuộc gọi.", "Chuỗi cung ứng", "Bài học cho đơn vị khác", "- Điểm lấy mẫu: sông Nhè; kết quả 57,7 mg/l.", "Kết luận [1] dẫn [Phụ lục 2] và bảng <3> của sở, phần $ quy đổi để riêng."])
def test_report_line(line):
    assert furniture_lines(f"Một câu của báo hôm nay.\n{line}\nMột câu khác của báo.") == []

"""Page readers on small pages of the known shapes."""

from placeflow.functions import html

SECTION = '<div class="x DAQTB"><h3 class="fr6Pj">{}</h3>{}</div>'


def test_table_rows_and_router():
    table = "<table><tbody><tr><th>내과</th><td>2<b>명</b></td></tr><tr><td>x</td></tr></tbody></table>"
    info = html.medical_info(SECTION.format("진료과목별 전문의 정보 3 진료과목", table))
    assert info == {"specialist_by_department": [{"department": "내과", "specialist_count": "2명"}]}
    assert html.medical_info(SECTION.format("특수진료장비", "<table><tr><td>a</td><td>b</td></tr></table>")) == {}


def test_lists_parking_and_footer():
    ul = '<ul class="xrrcZ"><li class="zxtJF">내과</li><li class="zxtJF"> </li><li>x</li><li class="zxtJF a">외과</li></ul>'
    assert html.medical_info(SECTION.format("진료과목", ul)) == {"medical_departments": ["내과", "외과"]}
    assert html.medical_info(SECTION.format("주차", "<p>무료 1시간</p>")) == {"parking_text": "무료 1시간"}
    assert html.medical_info(SECTION.format("주차", ul)) == {"parking": ["내과", "외과"]}
    assert html.medical_info(SECTION.format("주차", "<ul></ul>")) == {}
    foot = '<div class="w8afO">출처</div><div class="x4zu8"><a class="place_bluelink" href="/m">더보기</a></div>'
    assert html.medical_info(foot) == {"copyright_info": "출처", "more_info_link": "/m", "more_info_text": "더보기"}


def test_later_section_of_a_kind_overwrites_and_headless_ones_are_ignored():
    row = '<table><tbody><tr><td>{}</td><td>1</td></tr></tbody></table>'
    page = SECTION.format("의료인 수", row.format("a")) + SECTION.format("의료인 수", row.format("b")) + '<div class="DAQTB">주차</div>'
    assert html.medical_info(page) == {"medical_staff_count": [{"staff_type": "b", "count": "1"}]}


REVIEW = """<ul id="_review_list"><li class="place_apply_pui"><span class="pui__NMi-Dp">가</span><span class="pui__WN-kAf">리뷰 3</span>
<a data-pui-click-code="profile" href="/p">x</a><div class="lazyload-wrapper"><img src="http://a"><img src="data:image/x"><img src=""></div>
<div class="lazyload-wrapper"><img src="http://b"></div><div class="pui__vn15t2"><a data-pui-click-code="rvshowmore">줄1<br>줄2</a></div>
<span class="pui__V8F9nN">예약</span><span class="pui__V8F9nN"> </span>
<span class="pui__gfuUIT">방문일 <time>12.11.목</time></span><span class="pui__gfuUIT">2번째 방문</span><span class="pui__gfuUIT">영수증 인증</span>
<div class="pui__l8k0-f"><em class="pui__x-pa-u">4</em></div>{}</li><li>other</li><li class="place_apply_pui"></li></ul>"""


def test_reviews():
    first, second = html.reviews(REVIEW.format(""))
    assert first["review_index"] == 1 and second["review_index"] == 2
    assert first["review_text"] == "줄1\n줄2" and second["review_text"] == ""
    assert first["images"] == ["http://a"] and first["visit_keywords"] == ["예약"]
    assert first["visit_info"] == {"visit_date": "12.11.목", "visit_count": "2번째 방문", "verification_method": "영수증 인증"}
    assert first["reviewer_info"] == {"reviewer_name": "가", "reviewer_stats": ["리뷰 3"], "profile_url": "/p"}
    assert first["reactions"] == {"reaction_count": "4"} and first["owner_response"] is None
    assert html.reviews("<p>nothing</p>") == []


def test_owner_response():
    box = '<div class="pui__GbW8H7"><span class="pui__XE54q7">원장</span><span class="pui__4APmFd"><time>1.2.</time></span><div class="pui__J0tczd">{}</div></div>'
    got = html.reviews(REVIEW.format(box.format('<a data-pui-click-code="text">감사</a>접기')))[0]["owner_response"]
    assert got == {"owner_name": "원장", "response_date": "1.2.", "response_text": "감사"}
    assert html.reviews(REVIEW.format(box.format("감사<br>또")))[0]["owner_response"]["response_text"] == "감사\n또"


def test_facility_and_search_items():
    page = '<span class="GHAhO"> 가온 </span><span class="PXMot">방문자 1</span><span class="PXMot">블로그 2</span><div class="w9QyJ"><em>진료 중</em><span class="i8cJw">월</span><div class="H3ua4">09:00</div></div>'
    got = html.facility(page)
    assert got["name"] == "가온" and got["phone"] == "N/A" and got["reviews"] == "방문자 1, 블로그 2"
    assert got["hours_status"] == "진료 중" and got["business_hours"] == "월: 09:00"
    items = html.search_items('<ul><li><a href="/1"><span class="TYaxT">나</span></a></li><li> </li><li>다<br>라</li><li><a href="/2"></a></li></ul>')
    assert [i["name"] for i in items] == ["나", "다", "Unknown"] and items[0]["href"] == "/1"


def test_lenient_pages_and_medical_section():
    assert html.parse("<p>a<b>b<br>c</p><!-- x -->d").text("|") == "a|b|c|d"
    page = '<div class="place_section"><h2 class="place_section_header"><div class="place_section_header_title">진료정보</div></h2><div class="place_section_content">x<p>y</p></div></div>'
    assert html.medical_section(page) == ("x<p>y</p>", True) and html.medical_section("<p>") == (None, False)


def test_html_comes_back_as_written():
    page = '<ul id="a" data-x="1 &amp; &quot;2&quot;"><li>x &lt; y &amp; z<br><img src="i"></li><script>a < b && c</script></ul>'
    node = html.parse(page).find("ul")
    assert node.outer() == page and html.parse(node.outer()).find("ul").outer() == page
    deep = "<b>" * 5000 + "x" + "</b>" * 5000
    assert html.parse(deep).inner() == deep


def test_hidden_links_are_passed_over():
    li = '<li><a class="tzwk0" href="/1" style="Display : none"></a><div hidden><a class="place_bluelink" href="/2"></a></div><a>no</a><a href="/3" style="color:red">x</a></li>'
    assert html.clickable(html.parse(li).find("li")) == "/3"
    assert html.clickable(html.parse('<li><a href="/1" style="visibility:hidden">x</a></li>').find("li")) is None


def test_errors_are_data(spark):
    df = spark.createDataFrame([("<div>a</div>",), (None,)], "html string")
    rows = df.select(html.read_texts("html", "div").alias("r")).select("r.*").collect()
    assert rows[0]["value"] == ["a"] and rows[1]["value"] is None and rows[1]["error"] is None

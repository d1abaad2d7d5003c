"""Row-local functions against edge rows and plain Python."""

import html
import html.parser
import random
import re

import pytest
from pyspark.sql import functions as F

from digestloom.functions import dates, html as page, post, slug, text, urls
from digestloom.sources.pages import parse_articles

GOLDEN_SLUGS = {
    "[AI와 디지털전환] 2026년 월드컵, AI 업계가 가슴에 새겨야 할 교훈": "aiwa-dijiteoljeonhwan-2026nyeon-weoldeukeob-ai-eob",
    "보안株 '반짝 상승' 끝…시총 기준 강화에 상장폐지 불안": "boanzhu-banjjag-sangseung-ggeut-sicong-gijun-gangh",
    "'모두의 AI'로 한국형 '토큰 이코노미' 시동": "moduyi-ai-ro-hangughyeong-tokeun-ikonomi-sidong",
    "두루이디에스, '두루에너아이'로 사명 변경": "duruidieseu-durueneoai-ro-samyeong-byeongyeong",
    "AIDC 얼라이언스 출범": "aidc-eolraieonseu-culbeom",
    "[인사] 행정안전부": "insa-haengjeonganjeonbu",
    "안랩, 2분기 영업익 54억원…전년比 55.6% 증가": "anraeb-2bungi-yeongeobig-54eogweon-jeonnyeonbi-55",
    "SW저작권協·율촌, SW 포렌식 전문성 대폭 강화": "swjeojaggweonxie-yulcon-sw-porensig-jeonmunseong-d",
    "韓 AI 스타트업 3사, 오라클 클라우드 인프라 도입...글로벌 AI 시장 공략": "han-ai-seutateueob-3sa-orakeul-keulraudeu-inpeura",
    "[ET시선] '모두의 AI'는 국민이 만든다": "etsiseon-moduyi-ai-neun-gugmini-mandeunda",
    "씨큐비스타, NDR·보안컨설팅 결합…공공·금융시장 공략": "ssikyubiseuta-ndr-boankeonseolting-gyeolhab-gonggo",
    "HSAD 연출 AI 단편 영화, 美·佛 영화제 수상": "hsad-yeoncul-ai-danpyeon-yeonghwa-mei-fo-yeonghwaj",
    "Prix: 1,234,567 € für Čapek’s Straße": "prix-1234567-fur-capeks-strasse",
    "!!!": "",
}


def column(spark, values, sql, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", F.expr(sql).alias("y")).orderBy("i").collect()]


def test_golden_slugs(spark):
    assert column(spark, GOLDEN_SLUGS, slug.slugify("x")) == list(GOLDEN_SLUGS.values())


def test_strip_and_words_know_all_whitespace(spark):
    samples = [f"{c}a{c}{c}b{c}" for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"]
    assert column(spark, samples, text.strip("x")) == [s.strip() for s in samples]
    assert column(spark, samples, text.words("x")) == [s.split() for s in samples]


def test_sentences(spark):
    samples = ["A b. C d!  E?\nF", "no end", "", "  \n ", "v1.2 stays. x", "...  a", None]
    expected = [
        [p.strip() for p in re.split(r"(?<=[.!?])\s+", (s or "").strip()) if p.strip()] for s in samples
    ]
    assert column(spark, samples, text.sentences("x")) == expected


def test_sentences_may_end_at_line_breaks(spark):
    assert column(spark, ["a\nb. c"], text.sentences("x", split_newlines=True)) == [["a", "b.", "c"]]


def test_tokens(spark):
    got = column(spark, ["것 AI가 a 기자 Foo_bar 42 7", "그리고", None], text.content_tokens("x"))
    assert got == [["ai가", "foo", "bar", "42"], [], []]


def test_published_ts(spark):
    samples = ["2026-07-19 09:57", " 2026-7-1  9:05 ", "2026-02-30 10:00", "2026-07-19", "", None, "2026-07-19 24:00"]
    got = [str(v) if v else None for v in column(spark, samples, dates.published_ts("x"))]
    assert got == ["2026-07-19 09:57:00", "2026-07-01 09:05:00", None, None, None, None, None]


def test_lookback_bound_is_inside_and_unknown_dates_stay(spark):
    samples = ["2026-07-12 00:00", "2026-07-11 23:59", "2027-01-01 00:00", "soon", None]
    got = column(spark, samples, dates.within_lookback("x", 7, "2026-07-19 00:00:00"))
    assert got == [True, False, True, True, True]
    with pytest.raises(ValueError):
        dates.cutoff(0, "2026-07-19 00:00:00")


def test_run_stamp(spark):
    stamp = dates.run_stamp(dates.wall_time("2026-08-20 10:01:43.174481"))
    assert column(spark, ["x"], stamp) == ["2026-08-20T10:01:43.174481+09:00"]


def test_urls(spark):
    links = ["https://a.b/c?id1=04&x=1#f", "https://a.b/20260721000088", "not a url", None]
    assert column(spark, links, urls.query_param("x", "id1")) == ["04", None, None, None]
    assert column(spark, links, urls.id_from_url("x")) == [None, "20260721000088", None, None]
    with pytest.raises(Exception, match="no id1= parameter"):
        column(spark, ["https://a.b/"], urls.query_param("x", "id1", strict=True))
    ids = [" 20260721000088 ", "2026", None, "2026072100008x"]
    assert column(spark, ids, urls.valid_id("x")) == [True, False, False, False]


def test_yaml_scalars_read_back(spark):
    yaml = pytest.importorskip("yaml")
    samples = [
        "plain", "[AI] x", "it's", "'quoted' start", "a: b", "a #b", "- x", "-x", "no", "2026", "1_0", "0x1f",
        "1.5", "2026-07-21", "null", "~", "", "x:", "? y", "@x", "100%", "%x", "**bold**", "a, b", "<<", "=", "!t",
        "한글 제목", "tab\there", 'say "hi"', "back\\slash",
    ]
    alone = column(spark, samples, post.yaml_scalar("x"))
    listed = column(spark, samples, post.yaml_scalar("x", in_list=True))
    for sample, a, b in zip(samples, alone, listed):
        assert yaml.safe_load(f"k: {a}") == {"k": sample}
        assert yaml.safe_load(f"k: [{b}]") == {"k": [sample]}
    plain = [s for s in samples if "\t" not in s]
    dumped = [
        yaml.safe_dump({"k": s, "l": [s]}, allow_unicode=True, default_flow_style=None).splitlines()
        for s in plain
    ]
    assert column(spark, plain, post.yaml_scalar("x")) == [d[0][3:] for d in dumped]
    assert column(spark, plain, post.yaml_list("array(x)")) == [d[1][3:] for d in dumped]
    assert column(spark, alone, post.unquote_yaml("x")) == samples


ARTICLE = """<html><head><meta content="Other &amp; title" property="og:title"></head><body>
<!-- <div id="articleBody">no</div> -->
<div class="top timewrap"><div class="time"><time>수정 : 2026-07-20 10:00</time>
<time>발행일 : 2026-07-19 09:57</time></div></div>
{title}
<div class='x' id='articleBody'><p>One <b>two</b></p><div>in <div>ner</div></div>
<script>var t = "</div>";</script><figure><img><figure>f</figure>cap</figure>
<p title="a>b">&lt;p&gt; &#54620;&#x1F600; &amp;lt; &bogus; AT&T<br>end</div><div>outside</div></body></html>"""


def articles(spark, pages):
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(pages)], "article_id string, html string")
    return parse_articles(df, "https://n.example").orderBy("article_id").collect()


def test_article_page(spark):
    full, bare, empty, missing = articles(
        spark,
        [
            ARTICLE.format(title='<h2 id="article_title_h2"> A <i>b</i>&quot;c </h2>'),
            ARTICLE.format(title="").replace("발행일 : ", "발행일 ").replace("수정 : ", ""),
            "",
            None,
        ],
    )
    assert full.title == 'Ab"c'
    assert full.published_at == "2026-07-19 09:57"
    assert full.raw_text.split("\n") == [
        "One", "two", "in", "ner", "<p> 한😀 &lt; &bogus; AT&T", "end",
    ]
    assert full.url == "https://n.example/0"
    assert bare.title == "Other & title"
    assert bare.published_at == "57" or bare.published_at.endswith("57")
    assert (empty.title, empty.published_at, empty.raw_text, empty.error) == ("", "", "", None)
    assert missing.error == "page cannot be read"


class _Nodes(html.parser.HTMLParser):
    """Text nodes of the first article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.skip, self.done, self.nodes, self.open = 0, 0, False, [], False

    def handle_starttag(self, tag, attrs):
        self.open = False
        if tag == "article":
            self.depth += 1
        if tag in page.DROPPED_ELEMENTS:
            self.skip += 1

    def handle_endtag(self, tag):
        self.open = False
        if tag == "article":
            self.depth -= 1
            self.done = self.done or self.depth == 0
        if tag in page.DROPPED_ELEMENTS:
            self.skip -= 1

    def handle_comment(self, data):
        self.open = False

    def handle_data(self, data):
        if self.depth and not self.done and not self.skip:
            if self.open:
                self.nodes[-1] += data
            else:
                self.nodes.append(data)
            self.open = True


def test_body_text_equals_an_html_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    sql = page.body_text(page.drop_hidden("html"), "article")
    for row in pages.select("html", F.expr(sql).alias("got")).collect():
        parser = _Nodes()
        parser.feed(row.html)
        parser.close()
        assert row.got == "\n".join(t for t in (n.strip() for n in parser.nodes) if t)


def test_entities_decode_once(spark):
    random.seed(3)
    parts = ["&amp;", "&lt;", "&#65;", "&#x41;", "&eacute;", "&", ";", "amp;", "x", "&nbsp;", "&#38;lt;"]
    samples = ["".join(random.choices(parts, k=8)) for _ in range(200)]
    expected = [re.sub(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]+);", lambda m: html.unescape(m[0]), s) for s in samples]
    assert column(spark, samples, page.decode_entities("x")) == expected


def test_reading_minutes(spark):
    assert column(spark, ["a " * 401, "", None], text.reading_minutes("x")) == [3, 1, 1]

"""Saved pages of each site."""

from tidemill.sources import sites

FACEBOOK = '''<div data-ad-preview="message">The post</div><div role="article"><a role="link"><span dir="auto">Ann</span></a>
<div dir="auto">nice <a href="x">tag</a><img alt=":)"> one</div><a role="link">3d</a></div><div role="article"><div dir="auto"> </div></div>'''
TIKTOK = '<h1>clip</h1><div class="x-DivCommentContentContainer"><div><a>bo</a><p>first</p><p><span>2h ago</span></p></div></div>'
YOUTUBE = '''<h1 class="style ytd-watch-metadata"><yt-formatted-string>title</yt-formatted-string></h1><ytd-thread><div id="comment"><div id="author-text"><a>@a</a></div>
<div id="content-text"><span class="yt-core-attributed-string">hello <a>@x</a>all</span></div><span id="published-time-text"><a>1 ngày trước</a></span></div>
<ytd-comment-replies-renderer><ytd-comment-view-model><div id="author-text"><span>@b</span></div><div id="content-text">reply<br>two</div></ytd-comment-view-model></ytd-comment-replies-renderer></ytd-thread>
<ytd-thread><div id="comment"><div id="content-text">second</div></div></ytd-thread>'''
REDDIT = '''<h1>t</h1><shreddit-comment thingid="t1" author="u1"><div id="t1-post-rtjson-content"><p> a </p><p></p><p>b</p></div><faceplate-timeago><time>1 h. ago</time></faceplate-timeago>
<shreddit-comment thingid="t2" author=""><div id="t2-post-rtjson-content"><p>[deleted] c</p></div></shreddit-comment></shreddit-comment><shreddit-comment thingid="t3"></shreddit-comment>'''
THREADS = '<div data-pressable-container="true"><a href="/@ann">ann</a><time>2h</time><span dir="auto">a longer comment</span></div><div data-pressable-container="true"><span>x</span></div>'


def rows(html, site):
    return [(r[1], *r[3:]) for r in sites.extract(html, sites.SITES[site])]


def test_sites():
    assert rows(FACEBOOK, "facebook") == [(False, "Ann", "3d", "nice  one")]
    assert rows(TIKTOK, "tiktok") == [(False, "bo", "2h ago", "first")]
    assert rows(YOUTUBE, "youtube") == [(False, "@a", "1 ngày trước", "hello all"), (True, "@b", "N/A", "reply\ntwo"), (False, "Unknown", "N/A", "second")]
    assert rows(REDDIT, "reddit") == [(False, "u1", "1 h. ago", "a b"), (False, "deleted", "N/A", "[deleted] c")]
    assert rows(THREADS, "threads") == [(False, "ann", "2h", "a longer comment")]
    assert rows("", "reddit") == [] and rows("<div <p>broken", "facebook") == []


def test_comments(spark):
    df = spark.createDataFrame([(1, REDDIT), (2, None)], "page_id long, html string")
    got = sites.numbered(sites.comments(df, "reddit")).orderBy("place").collect()
    assert [(r.comment_id, r.post_raw, r.comment_raw) for r in got] == [("1_1", "t", "a b"), ("1_2", "t", "[deleted] c")]

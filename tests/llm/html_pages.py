"""Pages written by hand, of layouts that the training generator does not draw: ``(name, markup, blocks)``."""

A = "The bridge over the Elm was closed on Tuesday after inspectors found cracks in two of the northern piers."
B = "Drivers are being sent through the old town, where queues stretched for more than a mile by nine in the morning."
C = "Engineers said that the repair would take at least six weeks, and that a temporary crossing was not possible at this time of year."
D = "Shop owners in the centre were not pleased. One baker, who asked not to be named, said she had lost a third of her trade."
E = "The council will meet again on Friday to decide whether heavy lorries should be banned until the spring."
SHORT = "It has happened before."
T = "Bridge closed after cracks are found"

PAGES = [
    ("div paragraphs in article", f"<body><div id=nav><a href=/>Home</a> <a href=/n>News</a></div><article><h1>{T}</h1><div>{A}</div><div>{B}</div><div>{C}</div></article></body>", [T, A, B, C]),
    ("div paragraphs in a content div", f"<body><nav><a href=/>Home</a><a href=/a>About</a></nav><div class=content><h1>{T}</h1><div>{A}</div><div>{B}</div><div>{D}</div><div>{E}</div></div><footer>&copy; Elm Times</footer></body>", [T, A, B, D, E]),
    ("div paragraphs in a plain div", f"<body><div><h1>{T}</h1><div>{A}</div><div>{B}</div><div>{C}</div><div>{D}</div></div></body>", [T, A, B, C, D]),
    ("deep main", f"<body><main><section><div><h1>{T}</h1><div>{A}</div><div>{C}</div><div>{E}</div></div></section></main><aside><h3>Most read</h3><ul><li><a href=/1>Snow in May</a><li><a href=/2>Fair dates</a></ul></aside></body>", [T, A, C, E]),
    ("misleading class names", f"<body><div class=post><div class=post-header-image><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p></div></div></body>", [T, A, B, C]),
    ("generated class names", f"<body><div class=css-1x2y3z><div class=sc-fznKkj><h1 class=sc-a1>{T}</h1><div class=sc-b2>{A}</div><div class=sc-b2>{B}</div><div class=sc-b2>{C}</div><div class=sc-b2>{D}</div></div></div></body>", [T, A, B, C, D]),
    ("bare text and breaks", f"<body><div id=menu><a href=/>Home</a> | <a href=/c>Contact</a></div><div><h2>{T}</h2>{A}<br><br>{B}<br><br>{D}</div></body>", [T, f"{A} {B} {D}"]),
    ("spans in divs", f"<body><article><h1><span>{T}</span></h1><div><span>{A}</span></div><div><span>{B}</span> <span>{SHORT}</span></div><div><span>{E}</span></div></article><div class=share-buttons><a href=/f>Share</a> <a href=/t>Tweet</a></div></body>", [T, A, f"{B} {SHORT}", E]),
    ("article with byline and tags", f"<body><article><header><h1>{T}</h1><p class=byline>By R. Dale, 4 March</p></header><p>{A}</p><p>{B}</p><p>{C}</p><footer>Filed under: <a href=/t/1>roads</a>, <a href=/t/2>council</a></footer></article></body>", [T, A, B, C]),
    ("table layout", f"<body><table width=100%><tr><td width=20%><a href=/>Home</a><br><a href=/n>News</a><br><a href=/s>Sport</a></td><td><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{D}</p></td></tr><tr><td colspan=2>Copyright 2004 Elm Times. All rights reserved.</td></tr></table></body>", [T, A, B, D]),
    ("two articles", f"<body><nav><ul><li><a href=/>Home</a></ul></nav><main><article><h2>{T}</h2><p>{A}</p><p>{B}</p></article><article><h2>What the council said</h2><p>{C}</p><p>{E}</p></article></main></body>", [T, A, B, "What the council said", C, E]),
    ("cookie box and newsletter form", f"<body><div class=cookie-consent><p>We use cookies to give you the best experience on our site.</p><button>OK</button></div><div class=story-body><h1>{T}</h1><div class=text-block>{A}</div><div class=text-block>{C}</div><form action=/join><p>Get the morning letter in your inbox.</p><input type=email></form><div class=text-block>{E}</div></div></body>", [T, A, C, E]),
    ("reader comments", f"<body><article><h1>{T}</h1><p>{A}</p><p>{D}</p><p>{E}</p></article><section id=comments><h3>3 comments</h3><div class=comment><b>tom</b><p>I sat in that queue for an hour, never again.</p></div><div class=comment><b>ann</b><p>They knew about the cracks last year.</p></div></section></body>", [T, A, D, E]),
    ("quotes and lists", f"<body><article><h1>{T}</h1><div>{A}</div><blockquote><div>{C}</div></blockquote><ul><li>No lorries over ten tonnes</li><li>No parking on the quay</li><li>One lane at night</li></ul><div>{E}</div></article></body>", [T, A, C, "No lorries over ten tonnes", "No parking on the quay", "One lane at night", E]),
    ("sections with headings", f"<body><main><h1>{T}</h1><section><h2>What happened</h2><div>{A}</div></section><section><h2>Traffic</h2><div>{B}</div><div>{D}</div></section><section><h2>What is next</h2><div>{E}</div></section></main></body>", [T, "What happened", A, "Traffic", B, D, "What is next", E]),
    ("wrapper with sidebar", f"<body><div id=page class=has-sidebar><div id=primary><h1 class=entry-title>{T}</h1><div class=entry-content><div>{A}</div><div>{B}</div><div>{C}</div></div></div><div id=secondary class='widget-area sidebar'><div class=widget><h4>Weather</h4><p>Rain until noon, then clear.</p></div><div class=widget><h4>Archive</h4><ul><li><a href=/3>March</a><li><a href=/2>February</a></ul></div></div></div></body>", [T, A, B, C]),
    ("advert between divs", f"<body><div class=article-body><h1>{T}</h1><div>{A}</div><div class=ad-slot>New tyres from 40, fitted today.</div><div>{B}</div><div class=advertisement><a href=/x>Win a holiday in the sun</a></div><div>{D}</div><div>{E}</div></div></body>", [T, A, B, D, E]),
    ("upper-case tags, no end tags", f"<HTML><BODY><H1>{T}</H1><P>{A}<P>{B}<P>{C}<HR><A HREF=/>Home</A> | <A HREF=/n>News</A> | <A HREF=/c>Contact</A></BODY></HTML>", [T, A, B, C]),
    ("breadcrumbs and pager", f"<body><div class=breadcrumbs><a href=/>Home</a> &raquo; <a href=/n>News</a></div><div class=post-content><h1>{T}</h1><p>{A}</p><div>{B}</div><p>{E}</p></div><div class=pagination><a href=/p2>Next</a> <a href=/p0>Previous</a></div></body>", [T, A, B, E]),
    ("role attributes", f"<body><div role=navigation><a href=/>Home</a><a href=/n>News</a></div><div role=main><h1>{T}</h1><div>{A}</div><div>{C}</div><div>{D}</div></div><div role=complementary><p>Read more from our partners.</p></div><div role=contentinfo><p>Elm Times, 1 Quay Street</p></div></body>", [T, A, C, D]),
    ("headline and one long div", f"<body><header><a href=/>Elm Times</a><p>News for the valley</p></header><div class=story><h1>{T}</h1><div>{A} {B} {C} {D} {E}</div></div></body>", [T, f"{A} {B} {C} {D} {E}"]),
    ("links inside paragraphs", f"<body><article><h1>{T}</h1><div>{A} See <a href=/map>the map of detours</a> for details.</div><div>{B}</div><div><a href=/u>{SHORT}</a> {C}</div></article></body>", [T, f"{A} See the map of detours for details.", B, f"{SHORT} {C}"]),
    ("figure with caption", f"<body><article><h1>{T}</h1><figure><img src=b.jpg></figure><div>{A}</div><div>{B}</div><div>{E}</div></article><div class=related-posts><h3>Related</h3><a href=/1>Ferry to run again</a><a href=/2>Old mill sold</a></div></body>", [T, A, B, E]),
    ("many short div paragraphs", "<body><div class=chapter><h1>Night on the river</h1>" + "".join(f"<div>{x}</div>" for x in (SHORT, A, SHORT, B, "Nobody spoke.", D, "The lamp went out.", E)) + "</div></body>", ["Night on the river", SHORT, A, SHORT, B, "Nobody spoke.", D, "The lamp went out.", E]),
]

"""Pages marked by hand, of layouts that the model's own training pages were not made after: (layout, blocks that are main text, html)."""

PAGES = [
    ("blog", ["A winter walk", "The path behind the mill was frozen hard, and every step rang like a bell.", "We met nobody until noon, when a farmer waved from his gate.", "What to pack", "A flask of tea", "Two pairs of gloves", "By the time we turned home the light had gone blue."], """<html><head><title>A winter walk – Hill Notes</title></head><body class="home single">
<div id="masthead"><a href="/">Hill Notes</a><p>walking since 2009</p></div><ul id="nav"><li><a href=/a>About</a><li><a href=/b>Archive</a><li><a href=/c>Contact</a></ul>
<div class="wrap"><div class="post hentry"><h1 class="entry-title">A winter walk</h1><p>The path behind the mill was frozen hard, and every step rang like a bell.</p><p>We met nobody until noon, when a farmer waved from his gate.</p><h2>What to pack</h2><ul><li>A flask of tea</li><li>Two pairs of gloves</li></ul><p>By the time we turned home the light had gone blue.</p></div>
<div id="sidebar"><h3>Recent posts</h3><ul><li><a href=1>Spring mud</a></li><li><a href=2>The old quarry</a></li></ul></div></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>Lovely pictures, thank you for sharing them with all of us.</p></div><div class="comment"><b>Bo</b><p>Which mill is it? I would like to go there.</p></div></div>
<div class="footer">&copy; Hill Notes. All rights reserved.</div></body></html>"""),
    ("news", ["Council votes to reopen the harbour line", "The regional council voted on Tuesday to reopen the harbour railway, closed since 1987.", "Trains could run as early as next autumn, officials said, if the bridge passes inspection.", "“It is about time,” said one member after the vote."], """<!doctype html><html><body><header><nav><a href="/">Home</a> <a href="/politics">Politics</a> <a href="/sport">Sport</a></nav></header>
<main><article><h1>Council votes to reopen the harbour line</h1><p>The regional council voted on Tuesday to reopen the harbour railway, closed since 1987.</p><aside class="ad">Advertisement <a href=x>Buy a boat today</a></aside><p>Trains could run as early as next autumn, officials said, if the bridge passes inspection.</p><p>&ldquo;It is about time,&rdquo; said one member after the vote.</p></article>
<section class="related"><h2>More on this</h2><ul><li><a href=a>Bridge closed again</a><li><a href=b>Ten years of delay</a></ul></section></main>
<footer><p>Contact the newsroom. Terms of use. Privacy.</p></footer><script>var x = "<p>not text</p>";</script></body></html>"""),
    ("documentation", ["Installing the daemon", "Download the archive and unpack it in a directory that the service user can read.", "Configuration", "Set the port in the configuration file, then restart the daemon.", "If the port is taken, the daemon exits with status 2 and writes a line to the log."], """<html><body><div class="topnav"><a href="/">Docs</a> | <a href="/api">API</a></div><div class="toc"><ul><li><a href="#i">Installing</a></li><li><a href="#c">Configuration</a></li></ul></div>
<div class="content" role="main"><h1>Installing the daemon</h1><p>Download the archive and unpack it in a directory that the service user can read.</p><h2>Configuration</h2><p>Set the port in the configuration file, then restart the daemon.</p><p>If the port is taken, the daemon exits with status 2 and writes a line to the log.</p></div>
<div class="pagination"><a href=p>Previous</a> <a href=n>Next</a></div><div class="footer">Built with care</div></body></html>"""),
    ("recipe", ["Lentil soup", "A thick soup for cold evenings, ready in forty minutes.", "200 g red lentils", "1 onion, chopped", "Fry the onion until soft, add the lentils and cover with water.", "Simmer for half an hour, then season and serve with bread."], """<html><body><div class="cookie-banner">We use cookies. <button>Accept</button></div><div id="header"><h2>Kitchen</h2><form action=/s><input name=q><button>Search</button></form></div>
<article class="recipe"><h1>Lentil soup</h1><p>A thick soup for cold evenings, ready in forty minutes.</p><ul class="ingredients"><li>200 g red lentils<li>1 onion, chopped</ul><ol><li>Fry the onion until soft, add the lentils and cover with water.</li><li>Simmer for half an hour, then season and serve with bread.</li></ol></article>
<div class="newsletter"><p>Get a recipe a week in your mailbox.</p><input type=email><button>Subscribe</button></div><div class="social"><a href=f>Share</a> <a href=t>Pin it</a></div></body></html>"""),
    ("unnamed", ["On keeping bees", "My grandfather kept his hives behind the orchard wall, where the morning sun reached them first. He spoke to the bees before he opened a hive, and he said that they knew his voice.", "In May they swarmed. We followed them across two fields with a sheet and a box, and by evening they hung quietly in the dark of the new hive.", "I have kept bees for thirty years since, and I still talk to them."], """<html><body><div><a href="/">Start</a> <a href="/x">Texts</a> <a href="/y">Links</a></div><div><h1>On keeping bees</h1><p>My grandfather kept his hives behind the orchard wall, where the morning sun reached them first. He spoke to the bees before he opened a hive, and he said that they knew his voice.</p>
<p>In May they swarmed. We followed them across two fields with a sheet and a box, and by evening they hung quietly in the dark of the new hive.</p><p>I have kept bees for thirty years since, and I still talk to them.</p></div><div><a href="/1">Older</a> <a href="/2">Newer</a></div></body></html>"""),
    ("table layout", ["The lighthouse at Skerry Point was lit for the first time in the autumn of 1824, and its keeper lived there alone for eleven winters.", "He kept a diary of the weather and of passing ships, which is now in the county museum."], """<html><body><table width=100%><tr><td colspan=2><font size=5>Coast pages</font></td></tr><tr><td width=120><a href=a>Home</a><br><a href=b>Maps</a><br><a href=c>Guestbook</a></td>
<td><p>The lighthouse at Skerry Point was lit for the first time in the autumn of 1824, and its keeper lived there alone for eleven winters.</p><p>He kept a diary of the weather and of passing ships, which is now in the county museum.</p></td></tr><tr><td colspan=2><font size=1>Best viewed at 800x600</font></td></tr></table></body></html>"""),
    ("short", ["The library is closed on Friday."], """<html><body><header><a href="/">Town library</a></header><nav><a href=1>Hours</a> <a href=2>Catalogue</a></nav><main><p>The library is closed on Friday.</p></main><footer>Main Street 4</footer></body></html>"""),
    ("magazine", ["Why rivers bend", "Water in a bend flows faster on the outside, and slowly eats the bank away.", "On the inside it drops its sand, and so the bend grows from year to year.", "When two bends meet, the river cuts through and leaves a lake behind.", "Such lakes are called oxbows, and they silt up within a few centuries."], """<html><body><div class="banner"><a href=x>50 % off all shoes this week only</a></div><div class="container"><div class="article-body"><h1>Why rivers bend</h1><div class="author-box">by K. Lund</div><p>Water in a bend flows faster on the outside, and slowly eats the bank away.</p><p>On the inside it drops its sand, and so the bend grows from year to year.</p><div class="promo"><p>Read our special issue on glaciers, now in shops.</p></div><p>When two bends meet, the river cuts through and leaves a lake behind.</p><p>Such lakes are called oxbows, and they silt up within a few centuries.</p></div>
<div class="trending"><h4>Trending</h4><a href=1>Ten facts about whales</a><a href=2>The longest tunnel</a></div></div><div id="disqus"><p>Join the discussion below and tell us what you think.</p></div><div class="legal">Imprint | Privacy</div></body></html>"""),
    ("German", ["Neue Brücke über die Aller eröffnet", "Nach drei Jahren Bauzeit wurde die neue Brücke am Samstag für den Verkehr freigegeben.", "Die alte Brücke soll im kommenden Jahr abgerissen werden."], """<html lang=de><body><div class="navbar"><ul><li><a href=/>Startseite</a><li><a href=/lokal>Lokales</a><li><a href=/sport>Sport</a></ul></div><div id="main"><div class="entry-content"><h1>Neue Brücke über die Aller eröffnet</h1><p>Nach drei Jahren Bauzeit wurde die neue Brücke am Samstag für den Verkehr freigegeben.</p><p>Die alte Brücke soll im kommenden Jahr abgerissen werden.</p></div></div>
<div class="widget"><h3>Meistgelesen</h3><ul><li><a href=1>Sturm in der Nacht</a></li></ul></div><div id="footer">Impressum Datenschutz</div></body></html>"""),
    ("quotes and code", ["A note on loops", "The old form is still common:", "for i in range(3): print(i)", "It reads well, and a reader once wrote to me:", "I never understood loops until I saw that line.", "So keep it."], """<html><body><div class="menu"><a href=/>Index</a></div><section class="post-content"><h2>A note on loops</h2><p>The old form is still common:</p><pre>for i in range(3): print(i)</pre><p>It reads well, and a reader once wrote to me:</p><blockquote>I never understood loops until I saw that line.</blockquote><p>So keep it.</p></section><div class="replies"><div class="reply"><p>First! I disagree with all of it, as I always do.</p></div></div></body></html>"""),
    ("unnamed with lists", ["How the ferry timetable is made", "Every spring a clerk lays out the tides for the coming year on a long table and marks the hours when the slipway stays dry. Those hours are closed to the large boats.", "Then the school holidays are drawn in, because on those days twice as many people cross, and a second crew must be found for the afternoon runs.", "Only after that does the printing begin."], """<html><body><ul><li><a href=1>Island</a><li><a href=2>Harbour</a><li><a href=3>Church</a><li><a href=4>School</a></ul><div><h1>How the ferry timetable is made</h1><p>Every spring a clerk lays out the tides for the coming year on a long table and marks the hours when the slipway stays dry. Those hours are closed to the large boats.</p><p>Then the school holidays are drawn in, because on those days twice as many people cross, and a second crew must be found for the afternoon runs.</p><p>Only after that does the printing begin.</p></div><ul><li><a href=5>Weather</a><li><a href=6>Post</a></ul></body></html>"""),
    ("notice and form", ["Opening hours change in June", "From the first of June the hall opens at nine and closes at six.", "Groups of more than ten should write to us a week ahead."], """<html><body><div id="consent"><p>This site stores data on your device.</p><button>Agree</button><button>Refuse</button></div><div class="page"><div class="sidebar"><form><label>Name</label><input><label>Mail</label><input><button>Send</button></form></div><div class="text"><h1>Opening hours change in June</h1><p>From the first of June the hall opens at nine and closes at six.</p><p>Groups of more than ten should write to us a week ahead.</p></div></div><div class="bottom"><a href=/imprint>Imprint</a></div></body></html>"""),
]

"""Small written-out inputs and what they give. People and hosts are invented.

Of a case table, the last columns are the expected ones.
"""

N = None

NAMES = (
    (1, "Ada Moss", "Ada", "Moss"),
    (2, "Moss, Ada", "Ada", "Moss"),
    (3, "Quinn Adeyo, LVN", "Quinn", "Adeyo"),
    (4, "Jane Doe, RN, BSN", "Jane", "Doe"),
    (5, "Dr. Ann Lee", "Ann", "Lee"),
    (6, "Poe, Jr.", "Jr.", "Poe"),
    (7, ",", N, N),
    (8, "Cher", "Cher", N),
    (9, "", N, N),
    (10, N, N, N),
    (11, "Smith, Dr. Mary Ann", "Mary", "Smith"),
    (12, "  Ana   Maria  Cruz ", "Ana", "Maria Cruz"),
    (13, "Coach", "Coach", N),
    (14, "RN, Bo", "Bo", "RN"),
)
JUNK = (
    (1, "Brazil", 1, 0),
    (2, "Congo - Kinshasa", 0, 1),
    (3, "Jordan-Smith, Ann", 1, 1),
    (4, "Georgia (Gigi) Poe", 1, 1),
    (5, "Room 12", 1, 1),
    (6, "Park City", 1, 1),
    (7, "A & B", 1, 1),
    (8, "Ada Moss", 0, 1),
    (9, "Lincoln Elementary School", 0, 0),
    (10, "Math Teacher", 0, 0),
    (11, "", 1, 0),
    (12, N, 1, 0),
    (13, "Moss,Ada", 0, 1),
    (14, "Last Names A-F", 1, 1),
    (15, "Read more", 0, 0),
)
LABELS = (
    (1, "Email  Ada Moss", "Ada Moss"),
    (2, "Titles: Title: Coach", "Coach"),
    (3, "Name: Role: X", "X"),
    (4, "Role: Name: X", "Name: X"),
    (5, N, N),
    (6, "Ada", "Ada"),
)
PHONES = (
    (1, "+1 (743) 555-3824", "(743) 555-3824", N),
    (2, "555.555.0100 x12", "(555) 555-0100", "12"),
    (3, "555-0100", "555-0100", N),
    (4, "call us", "call us", N),
    (5, "ext. 40", N, "40"),
    (6, "", N, N),
    (7, N, N, N),
    (8, "7435553824 Extension 9", "(743) 555-3824", "9"),
)
EMAILS = (
    (1, "mailto:A@x.example.org?subject=y", "a@x.example.org", N),
    (2, "mailto:a@x.example.org,b@x.example.org", N, N),
    (3, "%20a@x.example.net", "%20a@x.example.net", "%20a@x.example.net"),
    (4, "", N, N),
    (5, N, N, N),
    (6, " B@x.example.org. ", N, "b@x.example.org"),
    (7, "a@example.com", "a@example.com", N),
    (8, "logo@2x.png", "logo@2x.png", N),
    (9, "MAILTO:c@y.example.org", "c@y.example.org", N),
)
HEX = (
    (1, "4223026c2d30", "a@.or"),
    (2, "xyz", N),
    (3, "", N),
    (4, N, N),
    (5, "00616263", "abc"),
    (6, "0161", "`"),
    (7, "016", "\a"),
)
AT_DOT = (
    (1, "ada at mail dot example dot org", "ada@mail.example.org"),
    (2, "bo (at) x [dot] example.net, cy@y.example.org", "bo@x.example.net,cy@y.example.org"),
    (3, "information. Please", "inform@ion.please"),
    (4, "nothing here", ""),
)
URLS = (
    (1, "https://www.oak-isd.example.org:8080/a?b", "www.oak-isd.example.org:8080", "example.org", "https://www.oak-isd.example.org:8080/a?b", "https://www.oak-isd.example.org:8080", "Oak-Isd"),
    (2, "HTTP://U:p@Site.k12.tx.us/x", "u:p@site.k12.tx.us", "u", N, "https://HTTP:", "U:P@Site"),
    (3, "site.example.net", "", "", "https://site.example.net", "https://site.example.net", ""),
    (4, "https://localhost/x", "localhost", "localhost", N, "https://localhost", "Localhost"),
    (5, "http://a b.example.org/c", "a b.example.org", "example.org", "http://a b.example.org/c", "http://a b.example.org", "A B"),
)
A, T, S, H, O = "administration", "teacher", "support_staff", "health_services", "other"
ROLES = (
    (1, "Ann Lee, RN", "Principal", N, N, N, "Registered Nurse (RN)", "Health Services", H),
    (2, "A B", "Deputy Superintendent", N, N, N, "Assistant Superintendent", "Administration", A),
    (3, "A B", "Vice Principal", N, N, N, "Assistant Principal", "Administration", A),
    (4, "A B", "Kindergarten Teacher", N, N, N, "Art Teacher", "Fine Arts", T),
    (5, "A B", "Fine Arts Director", N, N, N, "Art Teacher", "Fine Arts", T),
    (6, "A B", "Band Director", N, N, N, "Band Director", "Fine Arts", T),
    (7, "A B", "School Resource Officer", N, N, N, "Security", "Security", S),
    (8, "A B", "Archivist", N, N, N, "Archivist", "General Staff", O),
    (9, "A B", "staff", "a@x.example.org", "https://x.example.org/departments/x", "S", "Art Teacher", "Fine Arts", T),
    (10, "A B", "", "a@x.example.org", "https://x.example.org/people", "S", "District Employee", "General Staff", O),
    (11, "A B", N, N, N, "Health Professions", "Health Professions Staff", "Health Services", H),
    (12, "A B", N, N, "https://x.example.org/admin", N, "Administrator", "Administration", A),
    (13, "A B", N, N, N, N, "Staff", "General Staff", O),
    (14, "A B", "Teacher", N, N, N, "Teacher", "Instruction", T),
    (15, "A B", "Trustee", N, N, N, "Board Member", "Board of Trustees", A),
    (16, "A B", N, N, "https://x.example.org/nurse", N, "Health Services Staff", "Health Services", H),
)
LEADS = (
    (1, "Superintendent", "", A, "D", "S", "Dist"),
    (2, "Staff", "District Employee", O, "D", "S", "Dist"),
    (3, "Dean", "Dean", A, "D", "S", "School"),
    (4, "Math Teacher", "", T, "D", "S", "Teacher"),
    (5, "Director", "", A, "D", "Oak Middle", "School"),
    (6, "Director", "", A, "D", "", "Dist"),
    (7, "Director", "", A, "Oak ISD", "oak isd", "Dist"),
    (8, "Coach Manager", "", O, "D", "S", "Other"),
    (9, "School Resource Officer", "Security", S, "D", "S", "School"),
    (10, "Nurse", "Nurse", H, "D", "S", "Other"),
    (11, "Chief", "", A, "D", "Central Office", "Dist"),
    (12, N, N, N, N, N, "Other"),
    (13, "Board Member", "", A, "D", "S", "Dist"),
)
CAMPUS_CODES = (
    (1, "/uploaded/faculty/A_HS/moss.jpg", "A_HS", "High School"),
    (2, "/uploaded/faculty/AHS/moss.jpg", "AHS", "AHS"),
    (3, "/x/staff/Colorado/moss.jpg", "Colorado", "Administration"),
    (4, "/faculty/images/moss.jpg", N, ""),
    (5, "/other/moss.jpg", N, ""),
    (6, N, N, ""),
    (7, "/staff/B_ELEM/x.png", "B_ELEM", "Elementary School"),
)
CAMPUS_NAMES = (
    (1, "Pre-K Teacher at Blanton Elementary", "Blanton Elementary"),
    (2, "the High School", "High School"),
    (3, "Oak Middle", "Oak Middle"),
    (4, "", ""),
    (5, "Math Science Oak Ridge Middle", "Oak Ridge Middle"),
)
PAGE_COUNTS = (
    (1, "showing 1 - 12 of 4487 constituents", 374),
    (2, "Showing 1 - 12 of 4,487 constituents", 374),
    (3, "<a href='?const_page=3'>3</a><a href='?const_page=11'>11</a>", 11),
    (4, "nothing", 1),
    (5, "showing 1 - 12 of 99999999", 1000),
    (6, "showing 1 - 0 of 5, const_page=4", 4),
)
FETCHES = ((1, 200, "text/html", 1), (2, 404, "text/html", 0), (3, 200, "application/pdf", 0), (4, 200, "", 1), (5, 301, "application/xml", 1), (6, 200, N, 1))
STYLES = (
    (1, 3, 4, 0, 0, 900, "email_table"),
    (2, 0, 4, 1, 0, 900, "email_table"),
    (3, 3, 0, 0, 3, 900, "card_grid_email"),
    (4, 0, 0, 0, 3, 900, "card_grid_no_email"),
    (5, 5, 0, 0, 0, 900, "mailto_list"),
    (6, 1, 0, 0, 0, 399, "js_or_empty"),
    (7, 0, 1, 0, 0, 900, "js_or_empty"),
    (8, 1, 0, 0, 0, 900, "unknown"),
)
CONSTRUCTED = ((1, "Ada", "Moss", "Oak.example.org", "amoss@oak.example.org", "constructed"), (2, "Bo", "O'Neil", "x.example.org", "boneil@x.example.org", "constructed"))

# ---- a page store

OAK, ELM, FIR = "https://oak.example.org", "https://elm.example.net", "https://fir.example.org"
_MAILS = '<p><a href="mailto:ada.moss@oak.example.org">Ada Moss</a></p><p><a href="mailto:bo.reed@oak.example.org">Bo Reed</a></p><p><a href="mailto:cy.lane@oak.example.org">Cy Lane</a></p>'
_FS = '<div class="fsConstituentItem" data-constituent-id="{i}"><h3 class="fsFullName"><a class="fsConstituentProfileLink" href="/fs/{i}">{n}</a></h3><div class="fsTitles">Titles: {t}</div>{m}</div>'


def _fs(*people: tuple[int, str, str, str]) -> str:
    return "".join(_FS.format(i=i, n=n, t=t, m=f'<a href="mailto:{m}">Email</a>' if m else "") for i, n, t, m in people)


PAGES = {
    OAK: f'<nav><a href="/login">Login</a></nav><a href="/schools/pine">Pine School</a><a href="{OAK}/schools/ash">Ash Elementary</a><a href="https://other.example.com/schools/x">Far School</a><a href="/about/staff">Our people</a>',
    f"{OAK}/sitemap.xml": f'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>{OAK}/schools/ash</loc></url><url><loc>{OAK}/schools/fern-hill_high</loc></url><url><loc>{OAK}/news/x</loc></url></urlset>',
    f"{OAK}/directory": f"<h1>Directory</h1>{_MAILS}",
    f"{OAK}/about/staff": f'{_MAILS}<a href="/about/staff/team">Team</a>',
    f"{OAK}/schools/ash": '<a href="/schools/ash/faculty">Faculty</a>',
    ELM: f'<a href="/x/faculty">Faculty</a><a href="/x/staff-list">Staff</a><a href="/x/doc.pdf">Staff list</a><a href="#staff">Staff</a><a href="{ELM}/x/faculty">Faculty again</a>',
    f"{ELM}/x/faculty": '<a href="/x/team">Our team</a><div class="staff">a</div>',
    f"{ELM}/sitemap.xml": f'<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><sitemap><loc>{ELM}/map1.xml</loc></sitemap></sitemapindex>',
    f"{ELM}/map1.xml": f'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>{ELM}/campus/low-field</loc></url></urlset>',
    # strategies
    f"{FIR}/people/finalsite": _fs((1, "Ada Moss", "Principal", "ada.moss@fir.example.org")) + '<script type="application/json">[{"name": "Json Person"}]</script>',
    f"{FIR}/people/json": '<script>var staff = [{"fullName": "Bo Reed", "jobTitle": "Coach", "email": "bo.reed@fir.example.org"}];</script><table><tr><td>h</td><td>h</td></tr><tr><td>Not Read</td><td>x</td></tr></table>',
    f"{FIR}/people/badjson": '<script type="application/json">[{"name": "Bo Reed"}, "x"]</script>',
    f"{FIR}/people/micro": "".join(f'<div itemscope itemtype="https://schema.org/person"><b itemprop="name">{n}</b><meta itemprop="jobTitle" content="Nurse"></div>' for n in ("Cy Lane", "Di Park")),
    f"{FIR}/people/hcard": "".join(f'<div class="vcard"><b class="fn">{n}</b><i class="title">Registrar</i></div>' for n in ("Ed Cole", "Flo Dean Hart")),
    f"{FIR}/people/table": '<table><tr><th>Name</th><th>Title</th></tr><tr><td>Gus Hill</td><td>Librarian</td><td>743-555-0100</td><td><a href="mailto:gus.hill@fir.example.org">gus.hill@fir.example.org</a></td></tr></table>',
    f"{FIR}/people/card": '<div class="staff-box"><h3>Hal Ives</h3><p>Custodian</p><span data-email="hal.ives@fir.example.org"></span></div>',
    f"{FIR}/people/onecard": '<div class="profile-box"><h3>Hal Ives</h3><p>Custodian</p></div>',
    f"{FIR}/people/definition": '<dl><dt>Ida Jay</dt><dd>Clerk <a href="mailto:ida.jay@fir.example.org">mail</a></dd><dt>Kim Low</dt><dd>Aide</dd></dl>',
    f"{FIR}/people/lostdefinition": '<dl><dt>Ida Jay</dt><dd>Clerk <a href="mailto:ida.jay@fir.example.org">Ida Jay</a></dd><dt>7</dt><dd>x</dd></dl>',
    f"{FIR}/people/mailto": '<div><h4>Leo Mann</h4><p>Bus Driver</p><a href="mailto:leo.mann@fir.example.org">Email</a></div><div><div><ul><li>Mia Nash <a href="mailto:mia.nash@fir.example.org">mia.nash@fir.example.org</a></li></ul></div></div>',
    f"{FIR}/people/countries": "<select><option>Brazil</option><option>Peru</option></select>",
    # pagination
    f"{FIR}/list/1": '<div class="pagination"><a href="/list/2">Next</a></div>',
    f"{FIR}/list/2": '<head><link rel="next" href="/list/3"></head>',
    f"{FIR}/list/3": '<a rel="next" href="/list/1">back to the start</a>',
    f"{FIR}/nav/1": '<nav class="pagination"><a href="/nav/2">Next</a></nav>',
    # vendors
    f"{FIR}/staff-directory": "showing 1 - 2 of 5" + _fs((11, "Ada Moss", "Math Teacher", "ada.moss@fir.example.org"), (12, "Bo Reed", "Director", "")),
    f"{FIR}/staff-directory?const_page=2": _fs((12, "Bo Reed", "Director", ""), (13, "Cy Lane", "", "cy.lane@fir.example.org")),
    f"{FIR}/staff-directory?const_page=3": _fs((11, "Ada Moss", "Math Teacher", "ada.moss@fir.example.org")),
    f"{FIR}/fs/12": '<main><a href="mailto:bo.reed@fir.example.org">write</a><div class="fsLocations">Location: Fir High School</div></main>',
    f"{FIR}/fox": '<div class="fbcms_staffentry"><div class="name">Di  Ann Park</div><div class="building">Fir Middle</div><div class="position">Math Teacher</div><a href="mailto:di.park@fir.example.org">mail</a></div><a href="?page=2">2</a><a href="?page=99">99</a>',
    f"{FIR}/fox?page=2": '<div class="fbcms_staffentry"><div class="name"><a href="/fox/ed">Ed Cole</a></div><div class="building">Administration</div><div class="position">Chief</div></div><div class="fbcms_staffentry"><div class="name">Di Ann Park</div><a href="mailto:di.park@fir.example.org">mail</a></div>',
    f"{FIR}/fox/ed": "<p>Write to ed.cole@fir.example.org</p>",
    # profiles and hits
    f"{FIR}/p/ada": '<a href="mailto:office@fir.example.org">office</a> or <a href="mailto:ada.moss@fir.example.org">me</a>',
    f"{FIR}/p/bo": "bo (at) fir dot org",
    f"{FIR}/hits": '<a href="mailto:Ada.Moss@fir.example.org?subject=x">Ada  Moss</a><a href="bo@fir.example.org">Bo</a><b data-cfemail="0062406669722e6578616d706c652e6f7267"></b>'
    '<i class="fsEmail">cy@fir.example.org</i><p>di at fir dot example dot org</p><p>ed@fir.example.org ada.moss@fir.example.org x@example.com</p>',
    # styles
    f"{FIR}/style/table": "<table>" + "<tr><td><a href='mailto:a@x.example.org'>a</a></td></tr>" * 4 + "</table>",
    f"{FIR}/style/cardmail": '<div class="staff"><a href="mailto:a@x.example.org">a</a></div>' * 3,
    f"{FIR}/style/card": '<div class="person">a</div>' * 3,
    f"{FIR}/style/mails": '<a href="mailto:a@x.example.org">a</a>' * 5,
    f"{FIR}/style/empty": "<p>loading</p>",
    f"{FIR}/style/other": "<a href='mailto:a@x.example.org'>a</a>" + "<p>long text</p>" * 80,
}
DISTRICTS = (("Oak", OAK), ("Elm", ELM), ("Gone", "https://gone.example.org"))
EXPECT_PROBE = (("Oak", OAK, f"{OAK}/directory", "path", "found"), ("Elm", ELM, f"{ELM}/x/staff-list", "crawl", "found"), ("Gone", "https://gone.example.org", "", "none", "not_found"))
EXPECT_CRAWL = (
    ("Oak", f"{OAK}/about/staff", 1), ("Oak", f"{OAK}/about/staff/team", 2),
    ("Elm", f"{ELM}/x/faculty", 1), ("Elm", f"{ELM}/x/team", 2), ("Elm", f"{ELM}/x/staff-list", 3),
)
EXPECT_SCHOOLS = (("Oak", f"{OAK}/schools/pine", "Pine School"), ("Oak", f"{OAK}/schools/ash", "Ash Elementary"), ("Oak", f"{OAK}/schools/fern-hill_high", "Fern Hill High"), ("Elm", f"{ELM}/campus/low-field", "Low Field"))
EXPECT_TARGETS = tuple((f"{d} — {n}", u, "finalsite") for d, u, n in EXPECT_SCHOOLS)
_P = f"{FIR}/people"
EXPECT_CASCADE = (
    (f"{_P}/finalsite", "finalsite", "Ada Moss", "Titles: Principal".removeprefix("Titles: "), "ada.moss@fir.example.org"),
    (f"{_P}/json", "json", "Bo Reed", "Coach", "bo.reed@fir.example.org"),
    (f"{_P}/micro", "microdata", "Cy Lane", "Nurse", N), (f"{_P}/micro", "microdata", "Di Park", "Nurse", N),
    (f"{_P}/hcard", "hcard", "Ed Cole", "Registrar", N), (f"{_P}/hcard", "hcard", "Flo Dean Hart", "Registrar", N),
    (f"{_P}/table", "table", "Gus Hill", "Librarian", "gus.hill@fir.example.org"),
    (f"{_P}/card", "card", "Hal Ives", "Custodian", "hal.ives@fir.example.org"),
    (f"{_P}/definition", "definition", "Ida Jay", "Clerk", "ida.jay@fir.example.org"), (f"{_P}/definition", "definition", "Kim Low", "Aide", N),
    (f"{_P}/mailto", "mailto", "Leo Mann", "Bus Driver", "leo.mann@fir.example.org"), (f"{_P}/mailto", "mailto", "Mia Nash", "District Employee", "mia.nash@fir.example.org"),
)
WALKS = ((1, f"{FIR}/list/1"), (2, f"{FIR}/nav/1"), (3, f"{FIR}/none"))
EXPECT_FOLLOW = ((1, f"{FIR}/list/1", 1), (1, f"{FIR}/list/2", 2), (1, f"{FIR}/list/3", 3), (2, f"{FIR}/nav/1", 1))
PROFILES = (("Fir", f"{FIR}/landing", " Finalsite ", 0), ("Fir", f"{FIR}/other", "finalsite", 1), ("Elm", ELM, "edlio", 2))
EXPECT_FINALSITE = (
    ("", "Ada", "Moss", "ada.moss@fir.example.org", "Math Teacher", "Teacher"),
    ("Fir High School", "Bo", "Reed", "bo.reed@fir.example.org", "Director", "Dist"),
    ("", "Cy", "Lane", "cy.lane@fir.example.org", "District Employee", "Dist"),
)
FOXBRIGHT = (("Fir", f"{FIR}/fox"),)
EXPECT_FOXBRIGHT = (("Fir", "Fir Middle", "Di", "Park", "di.park@fir.example.org", "Math Teacher", "Teacher"), ("Fir", "Administration", "Ed", "Cole", "ed.cole@fir.example.org", "Chief", "Dist"))
PEOPLE = (
    ("Ada Moss", "Ada", "Moss", N, f"{FIR}/p/ada", "d", 0, 0),
    ("Bo Reed", "Bo", "Reed", N, f"{FIR}/p/bo", "d", 0, 1),
    ("Cy Lane", "Cy", "Lane", "cy@x.example.org", f"{FIR}/p/ada", "d", 0, 2),
    ("Di Park", "Di", "Park", N, N, "d", 0, 3),
)
EXPECT_ENRICH = (("Ada Moss", "ada.moss@fir.example.org"), ("Bo Reed", "bo@fir.org"), ("Cy Lane", "cy@x.example.org"), ("Di Park", N))
EXPECT_HITS = (
    ("ada.moss@fir.example.org", "Ada Moss", "mailto"), ("bo@fir.example.org", "Bo", "href"), ("b@fir.example.org", "", "cloudflare"),
    ("cy@fir.example.org", "", "span"), ("di@fir.example.org", "", "at-dot"), ("ed@fir.example.org", "", "at-dot"),
)
_S = f"{FIR}/style"
EXPECT_STYLES = (
    (f"{_S}/table", "email_table", 4, 4, 0), (f"{_S}/cardmail", "card_grid_email", 3, 0, 3), (f"{_S}/card", "card_grid_no_email", 0, 0, 3),
    (f"{_S}/mails", "mailto_list", 5, 0, 0), (f"{_S}/empty", "js_or_empty", 0, 0, 0), (f"{_S}/other", "unknown", 1, 0, 0),
)
HANDLE_PEOPLE = (("Fir", "11", "11", "Ada", "Moss", 1, 0), ("Fir", "", "Bo Reed|None", "Bo", "Reed", 1, 1), ("Fir", "", "Bo Reeder|None", "Bo", "Reeder", 1, 2))
HANDLES = (("Fir", 1, "11", "x"), ("Fir", 2, "99", "bo reed"), ("Fir", 3, "", ""))
EXPECT_HANDLES = ((1, "11"), (2, "Bo Reed|None"), (3, N))
EXPORT_HEADERS = ("District Number", "District Name", "School Name", "County Name", "Region Number", "Web Page Address")
EXPORT = (
    ("'001902", "Oak ISD", "Oak ISD", "Dell", "7", ""),
    ("'001902", "Oak ISD", "Ash Elementary", "Other", "8", "www.oak.example.org"),
    ("'001903", "Elm ISD", "", "Dell", "7", " http://elm.example.net "),
    ("'001904", "No Web ISD", "", "Dell", "7", "a@b.example.org"),
    ("", "Bare ISD", "", "Dell", "7", "bare.example.org"),
    ("", "bare isd", "", "Late", "9", "late.example.org"),
    ("'1", "", "x", "y", "z", "w.example.org"),
)
EXPECT_DISTRICTS = (
    ("001902", "Oak ISD", "Dell", "7", "https://www.oak.example.org"), ("001903", "Elm ISD", "Dell", "7", "http://elm.example.net"),
    ("", "Bare ISD", "Dell", "7", "https://bare.example.org"),
)
KNOWN = (("Oak", OAK, f"{OAK}/directory"),)
EXPECT_FAN_OUT = (
    ("Oak", "Oak", f"{OAK}/directory"), ("Oak", "Pine School", f"{OAK}/schools/pine"), ("Oak", "Ash Elementary", f"{OAK}/schools/ash/faculty"),
    ("Oak", "Fern Hill High", f"{OAK}/schools/fern-hill_high"),
)
EXPECT_LEADS = (
    ("Oak", "Oak", "Ada", "Moss", "ada.moss@oak.example.org", "District Employee", "Dist"),
    ("Oak", "Oak", "Bo", "Reed", "bo.reed@oak.example.org", "District Employee", "Dist"),
    ("Oak", "Oak", "Cy", "Lane", "cy.lane@oak.example.org", "District Employee", "Dist"),
)

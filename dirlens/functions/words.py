"""Ordered keyword tables. Order is part of their meaning wherever the first hit wins.

Fixed values: the results depend on these words, patterns and labels exactly as they stand.
"""

LABELS = ("email ", "e-mail ", "titles:", "title:", "name:", "role:", "position:")

COUNTRIES = tuple(
    """
    afghanistan albania algeria andorra angola anguilla argentina armenia aruba australia austria
    azerbaijan bahamas bahrain bangladesh barbados belarus belgium belize benin bermuda bhutan
    bolivia botswana brazil brunei bulgaria burundi cambodia cameroon canada chad chile china
    colombia comoros croatia cuba curacao cyprus denmark djibouti dominica ecuador egypt eritrea
    estonia eswatini ethiopia fiji finland france gabon gambia georgia germany ghana gibraltar
    greece greenland grenada guadeloupe guam guatemala guernsey guinea guyana haiti honduras
    hungary iceland india indonesia iran iraq ireland israel italy jamaica japan jersey jordan
    kazakhstan kenya kiribati kosovo kuwait kyrgyzstan laos latvia lebanon lesotho liberia libya
    liechtenstein lithuania luxembourg macao madagascar malawi malaysia maldives mali malta
    martinique mauritania mauritius mayotte mexico micronesia moldova monaco mongolia montenegro
    montserrat morocco mozambique myanmar namibia nauru nepal netherlands nicaragua niger nigeria
    niue norway oman pakistan palau panama paraguay peru philippines poland portugal qatar romania
    rwanda samoa senegal serbia seychelles singapore slovakia slovenia somalia spain sudan suriname
    sweden switzerland syria taiwan tajikistan tanzania thailand togo tokelau tonga tunisia turkey
    turkmenistan tuvalu uganda ukraine uruguay uzbekistan vanuatu venezuela vietnam yemen zambia
    zimbabwe
    """.split()
)
JUNK_PATTERN = r"(?i)(&|\bislands?\b|\brepublic\b|\bterritory\b|\bcity\b|last names?\s+[a-z]\s*-\s*[a-z]|\ba-[a-z]\b|[0-9])"

CREDENTIALS = tuple(
    """
    RN LVN LPN BSN MSN NP APRN CNA PHD EDD MD DDS DVM PSYD MED MSED MBA JD CPA NBCT LCSW LPC LMSW
    LMFT OTR PT DPT SLP CCCSLP EDS ABD BCBA ATC RD LDN
    """.split()
)
HONORIFICS = tuple("DR MR MRS MS MX PROF PROFESSOR REV COACH FR SR HON SGT OFC OFFICER".split())
NURSES = (
    ("RN", "Registered Nurse (RN)"),
    ("BSN", "Registered Nurse (BSN)"),
    ("LVN", "Licensed Vocational Nurse (LVN)"),
    ("LPN", "Licensed Practical Nurse (LPN)"),
    ("NP", "Nurse Practitioner"),
)

SCHOOL_WORDS = (
    "elementary", "middle school", "high school", "academy", "preparatory", "collegiate", "primary",
    "secondary", "intermediate", "preschool", "early childhood", "magnet", "charter",
    "learning center", "school of", "junior high", "senior high", "campus",
)
NOT_PERSON_WORDS = ("cost:", "click here", "read more", "learn more", "$", "©", "copyright", "all rights reserved")
ROLE_WORDS = tuple(
    """
    teacher principal superintendent director coordinator counselor counselors librarian nurse coach
    coaches secretary clerk custodian janitor maintenance aide aides paraprofessional instructor
    professor dean supervisor manager administrator specialist assistant receptionist registrar
    psychologist therapist staff faculty department office services driver technician trustee
    president officer cafeteria security
    """.split()
)

#: (keyword, role, department): the first keyword contained in the text counts.
SUBJECTS = (
    ("math", "Math Teacher", "Mathematics"),
    ("science", "Science Teacher", "Science"),
    ("biology", "Science Teacher", "Science"),
    ("chemistry", "Science Teacher", "Science"),
    ("physics", "Science Teacher", "Science"),
    ("english", "English Teacher", "English/Language Arts"),
    ("language arts", "English Teacher", "English/Language Arts"),
    ("reading", "Reading Teacher", "Reading"),
    ("social studies", "Social Studies Teacher", "Social Studies"),
    ("history", "History Teacher", "History"),
    ("geography", "Social Studies Teacher", "Social Studies"),
    ("art", "Art Teacher", "Fine Arts"),
    ("music", "Music Teacher", "Fine Arts"),
    ("band", "Band Director", "Fine Arts"),
    ("orchestra", "Orchestra Director", "Fine Arts"),
    ("choir", "Choir Director", "Fine Arts"),
    ("theater", "Theater Teacher", "Fine Arts"),
    ("theatre", "Theater Teacher", "Fine Arts"),
    ("physical education", "PE Teacher", "Physical Education"),
    ("pe teacher", "PE Teacher", "Physical Education"),
    ("special education", "Special Education Teacher", "Special Education"),
    ("sped", "Special Education Teacher", "Special Education"),
    ("esl", "ESL Teacher", "ESL"),
    ("esol", "ESL Teacher", "ESL"),
    ("bilingual", "Bilingual Teacher", "Bilingual"),
    ("kindergarten", "Kindergarten Teacher", "Elementary"),
    ("pre-k", "Pre-K Teacher", "Early Childhood"),
    ("prek", "Pre-K Teacher", "Early Childhood"),
    ("computer", "Computer/Technology Teacher", "Technology"),
    ("career", "Career/Technology Teacher", "CTE"),
)

ADMIN, TEACHER, SUPPORT, HEALTH, ATHLETICS, OTHER = TYPES = "administration", "teacher", "support_staff", "health_services", "athletics", "other"

#: (any of these, and any of those if given, role, department, type); role None: the subject's.
TITLE_RULES = (
    (("superintendent",), ("assistant", "deputy", "associate"), "Assistant Superintendent", "Administration", ADMIN),
    (("superintendent",), (), "Superintendent", "Administration", ADMIN),
    (("principal",), ("assistant", "asst", "vice", "associate"), "Assistant Principal", "Administration", ADMIN),
    (("principal",), (), "Principal", "Administration", ADMIN),
    (("dean",), (), "Dean", "Administration", ADMIN),
    (("band director", "choir director", "orchestra director", "fine arts director", "theater director", "theatre director"), (), None, "Fine Arts Director", "Fine Arts"),
    (("director",), (), "Director", "Administration", ADMIN),
    (("coordinator",), (), "Coordinator", "Administration", ADMIN),
    (("supervisor",), (), "Supervisor", "Administration", ADMIN),
    (("chief",), (), "Chief Officer", "Administration", ADMIN),
    (("manager",), (), "Manager", "Administration", ADMIN),
    (("board", "trustee"), (), "Board Member", "Board of Trustees", ADMIN),
    (("counselor", "counseling"), (), "Counselor", "Counseling", SUPPORT),
    (("psycholog",), (), "School Psychologist", "Student Services", SUPPORT),
    (("librarian", "media specialist"), (), "Librarian", "Library", SUPPORT),
    (("nurse",), (), "Nurse", "Health Services", HEALTH),
    (("coach", "athletic"), (), "Coach/Athletics", "Athletics", ATHLETICS),
    (("teacher", "instructor", "educator", "professor", "lecturer", "faculty"), (), None, "Teacher", "Instruction"),
    (("secretary", "clerk", "registrar"), (), "Secretary/Clerk", "Administrative Support", SUPPORT),
    (("aide", "paraprofessional", "para-"), (), "Paraprofessional/Aide", "Instructional Support", SUPPORT),
    (("custodian", "janitor"), (), "Custodian", "Facilities", SUPPORT),
    (("maintenance",), (), "Maintenance", "Facilities", SUPPORT),
    (("security", "police", "officer"), (), "Security", "Security", SUPPORT),
    (("cafeteria", "food service", "nutrition"), (), "Food Service", "Nutrition Services", SUPPORT),
    (("bus driver", "transportation"), (), "Transportation Staff", "Transportation", SUPPORT),
    (("technolog", "technician", "it "), (), "Technology Staff", "Technology", SUPPORT),
)
#: Looked for in the directory's address where the title says nothing; the subjects come before the last.
ADDRESS_RULES = (
    (("nurse", "health-service", "health_service"), "Health Services Staff", "Health Services", HEALTH),
    (("coach", "athletic"), "Coach/Athletics", "Athletics", ATHLETICS),
    (("principal", "administration", "admin"), "Administrator", "Administration", ADMIN),
    (("counselor", "counseling"), "Counselor", "Counseling", SUPPORT),
    (("librar",), "Librarian", "Library", SUPPORT),
    (("teacher", "faculty"), "Teacher", "Instruction", TEACHER),
)
NO_TITLE = ("", "staff", "nan", "none")

LEAD_ORDER = ("Dist", "School", "Teacher", "Other")
LEAD_BOARD = ("trustee", "board member", "school board", "board of education")
LEAD_SCHOOL = ("principal", "head of school", "headmaster", "headmistress", "head teacher", "dean of students", "dean")
LEAD_TEACHER = ("teacher", "instructor", "educator", "professor", "lecturer", "faculty")
LEAD_ADMIN = ("director", "coordinator", "supervisor", "manager", "chief", "administrator", "executive", "cabinet", "officer")
DISTRICT_SCOPE = ("district", "central office", "administration building", "central administration", "district office", "board of education", "central services", "d.o.")

CMS = (
    ("finalsite", ("finalsite", "fs-cms", "fsconstituent", "fselement")),
    ("blackboard", ("blackboard", "bbdn", "webcommunitymanager")),
    ("edlio", ("edlio", "edl.io")),
    ("apptegy", ("apptegy", "thrillshare")),
    ("schoolblocks", ("schoolblocks",)),
    ("gabbart", ("gabbart",)),
    ("parentsquare", ("parentsquare",)),
    ("squarespace", ("squarespace",)),
    ("wordpress", ("wp-content", "wp-includes")),
)
VENDORS = (
    ("finalsite", ("finalsite",)),
    ("apptegy", ("apptegy", "thrillshare")),
    ("edlio", ("edlio", "edl.io")),
    ("blackboard", ("blackboard", "schoolwires", "myschoolcdn")),
    ("gabbart", ("gabbart",)),
    ("esc_regional", (".esc", "escregion", "region")),
    ("austinschools", ("austinschools.org",)),
    ("campusstar", ("campusstar",)),
)

SCHOOL_LINKS = r"/schools?/|/campus(?:es)?/|/sites?/|/locations?/|-elementary|-middle|-high-?school|-academy"
SKIPPED_LINKS = (
    "home", "login", "sign in", "contact", "calendar", "news", "event", "search", "policy", "menu", "nav", "back to",
    "privacy", "sitemap", "translate", "facebook", "twitter", "instagram", "youtube",
)
SKIPPED_ENDINGS = (".pdf", ".doc", ".docx", ".zip", ".jpg", ".jpeg", ".png", ".gif", ".mp4", ".xls", ".xlsx")
DIRECTORY_WORDS = (
    "directory", "staff", "faculty", "employee", "team", "administration", "leadership", "personnel", "people",
    "our-team", "our-staff", "meet-the", "meet-our", "contact-us", "who-we-are",
)
DIRECTORY_PATHS = (
    "/staff-directory", "/staff_directory", "/staffdirectory", "/directory", "/staff", "/our-staff", "/ourstaff",
    "/faculty-staff", "/faculty-and-staff", "/faculty", "/personnel", "/staff-directory.aspx", "/directory.aspx",
    "/departments/human-resources/staff-directory", "/about/staff-directory", "/about-us/staff-directory",
    "/staff/staff-directory",
)
VENDOR_PATHS = (
    "/staff-directory", "/quick-links/staff-directory", "/our-district/staff-directory", "/directory",
    "/our-district/directory", "/about/staff-directory", "/district/staff-directory", "/staff/staff-directory",
    "/departments/staff-directory", "/staff-directories",
)
NEXT_LABELS = ("next", "next page", "next »", "»", "›", ">", "more", "load more", "show more", "view more")

EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE = r"(?:\+?1[\s.\-]?)?\(?\d{3}\)?[\s.\-]?\d{3}[\s.\-]?\d{4}"
HIDDEN_EMAIL = r"([a-z0-9._%+\-]+)\s*(?:\[at\]|\(at\)|\s+at\s+|@)\s*([a-z0-9.\-]+?)\s*(?:\[dot\]|\(dot\)|\s+dot\s+|\.)\s*([a-z]{2,})"
DOT = r"\s*(?:\(|\[|\{)?\s*(?:dot|\.)\s*(?:\)|\]|\})?\s*"
AT_DOT = r"([a-zA-Z0-9._%+\-]+)\s*(?:\(|\[|\{)?\s*(?:at|@)\s*(?:\)|\]|\})?\s*([a-zA-Z0-9.\-]+(?:" + DOT + r"[a-zA-Z0-9.\-]+)+)"
BAD_DOMAINS = ("example.com", "sentry.io", "wixpress.com", "schema.org", "googleapis.com", "gstatic.com", "w3.org")
IMAGE_ENDINGS = (".png", ".jpg", ".gif", ".svg", ".webp")

PHOTO_FOLDER = r"/(?:faculty|staff|uploaded)/([A-Za-z0-9 _-]{1,20})/[^/]+$"
PHOTO_STOP = ("faculty", "staff", "uploaded", "images", "photos", "thumbs", "default", "admin_photos")
CAMPUS_STOP = tuple(
    """
    pre-k prek pre kindergarten teacher instructor aide at the of for in and & - assistant principal
    counselor coach director coordinator staff faculty grade math science english reading history art
    music pe special education ed esl bilingual elementary middle high school
    """.split()
)
CAMPUS_NAME = (
    r"([A-Z][A-Za-z.'&-]+(?:\s+[A-Za-z.'&-]+){0,4}\s+(?:Elementary|Intermediate|Middle|Junior High|High\s*School|Primary|"
    r"Preparatory|Prep|Academy|Early\s+(?:College|Childhood)(?:\s+(?:High\s*School|Center))?|Learning\s+Center|Campus|School|ISD|CISD))"
)
CAMPUS_LEVELS = (
    (r"(?:^|_)(HS|H\.?S)$|HIGH", "High School"),
    (r"(?:^|_)(MS|M\.?S|JH|JHS)$|MIDDLE|JUNIOR", "Middle School"),
    (r"(?:^|_)(IS|INT)$|INTERMEDIATE", "Intermediate School"),
    (r"(?:^|_)(ES|EL|ELEM)$|ELEMENTARY", "Elementary School"),
    (r"(?:^|_)(ECC|ECE|PK|PRE)$|EARLY|PRE-?K", "Early Childhood"),
    (r"ADMIN|CENTRAL|DISTRICT|DO\b", "Administration"),
)
CAMPUS_FIELDS = (
    ".fsLocations", ".fsBuildings", ".fsDepartments", "[class*='location' i]", "[class*='building' i]",
    "[class*='campus' i]", "[class*='school' i]", ".fsTitles", ".fsRoles", ".title", ".position",
)

CARDS = (
    'div[class*="staff"]', 'div[class*="employee"]', 'div[class*="faculty"]', 'div[class*="person"]',
    'div[class*="member"]', 'div[class*="profile"]', 'div[class*="directory-item"]', 'div[class*="teammember"]',
    'div[class*="team-member"]', 'div[class*="bio"]', 'div[class*="contact-card"]', 'article[class*="staff"]',
    'article[class*="person"]', 'li[class*="staff"]', 'li[class*="member"]', 'li[class*="person"]',
    'li[class*="employee"]', "[data-employee]", "[data-staff]", ".ce_staff", ".staff-list li", ".directory li",
)
TRUSTED_CARDS = ("staff", "employee", "faculty", "teammember", "team-member", "person")
DATA_KEYS = frozenset(
    "name email title firstname fullname first_name displayname display_name staffname employeename position jobtitle job_title role emailaddress last_name lastname".split()
)
NOISE = frozenset("script style noscript select option datalist nav footer".split())

# The selectors and labels under which pages hold what is read from them.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LINK_LABELS = ("email", "e-mail", "mail", "contact", "click here", "send email", "send", "more", "read more", "view profile", "profile")
PAGER_LINKS = '.pagination a, .pager a, [class*="pagination"] a, [class*="paging"] a, nav[aria-label*="pag" i] a'
PROFILE_FIELDS = {
    "department": ((".fsDepartments", ".fsConstituentDepartment", "[class*='department' i]"), ("Department", "Dept")),
    "location": ((".fsLocations", ".fsBuildings", ".fsConstituentLocation", "[class*='location' i]", "[class*='building' i]", "[class*='campus' i]"), ("Location", "Building", "Campus", "School")),
    "title": ((".fsTitles", ".fsRoles", ".fsConstituentTitle", "[class*='title' i]"), ("Title", "Position", "Role")),
}
PROFILE_ADDRESSES = (".fsEmail", ".fsStyleSROnly", ".fsConstituentEmail", "[class*='mail' i]")
PROFILE_REGION = ".fsConstituentProfile, .fsElementConstituentProfile, .fsModalContent, .fsProfile, main, #fsPageBody"
VENDOR_CARDS = (".fsConstituentItem, .fsConstituentProfile", "[class*='fsConstituent'], [class*='constituent' i]")
VENDOR_NAME = ".fsFullName, .fsConstituentName, .fsFullNameLink, h3, h4, .name"
VENDOR_TITLE = ".fsTitles, .fsConstituentTitle, .fsRoles, .title, .position"
VENDOR_LINK = "a.fsConstituentProfileLink, a.fsFullNameLink, .fsFullName a, a[href*='/profile'], a[href*='constituent']"

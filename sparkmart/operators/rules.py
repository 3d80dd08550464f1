"""Rule tables of the classifiers. All entries are fixed values.

Product and company names of a particular business are not listed here; pass
them to the classifier as extra entries.
"""

# (low, high, label), both ends included unless a fourth item says "below", first match wins; None is open.
ARR_BUCKETS = [
    (None, 0, "[00] < 0", "below"),
    (0, 250, "[01] 0-250"),
    (250, 500, "[02] 250-500"),
    (500, 1000, "[03] 500-1K"),
    (1000, 2500, "[04] 1K-2.5K"),
    (2500, 5000, "[05] 2.5K-5K"),
    (5000, 10000, "[06] 5K-10K"),
    (10000, 25000, "[07] 10K-25K"),
    (25000, 50000, "[08] 25K-50K"),
    (50000, 100000, "[09] 50K-100K"),
    (100000, 500000, "[10] 100K-500K"),
    (500000, 1000000, "[11] 500K-1M"),
    (1000000, None, "[12] 1M+"),
]

DAY_BUCKETS = [
    (0, 6, "[01] 0-6 Days"),
    (7, 14, "[02] 7-14 Days"),
    (15, 21, "[03] 15-21 Days"),
    (22, 30, "[04] 22-30 Days"),
    (31, 60, "[05] 31-60 Days"),
    (61, 90, "[06] 61-90 Days"),
    (91, 120, "[07] 91-120 Days"),
    (121, 180, "[08] 121-180 Days"),
    (181, 365, "[09] 181-365 Days"),
    (366, 730, "[10] 1-2 Years"),
    (731, 1095, "[11] 2-3 Years"),
    (1096, None, "[12] 3+ Years"),
]

SEAT_BUCKETS = [
    (None, 0, "[00] <= 0"),
    (1, 5, "[01] 1-5"),
    (6, 7, "[02] 6-7"),
    (8, 10, "[03] 8-10"),
    (11, 15, "[04] 11-15"),
    (16, 50, "[05] 16-50"),
    (51, 100, "[06] 51-100"),
    (101, 200, "[07] 101-200"),
    (201, 500, "[08] 201-500"),
    (501, 1000, "[09] 501-1,000"),
    (1001, None, "[10] 1,001+"),
]

# (upper bound excluded, label)
DEAL_SIZES = [
    (5000, "1 - Small (<5k)"),
    (25000, "2 - Medium (5k - 25k)"),
    (100000, "3 - Big (25k - 100k)"),
    (None, "4 - Jumbo (>100k)"),
]
ARR_SEGMENTS = [
    (5000, "Under 5K"),
    (50000, "5K to 50K"),
    (100000, "50K to 100K"),
    (500000, "100K to 500K"),
    (1000000, "500K to 1M"),
    (None, "1M and above"),
]
RANK_SEGMENTS = [
    (26, "First 25 Customer"),
    (51, "26 - 50 Customer"),
    (101, "51 - 100 Customer"),
    (501, "101 - 500 Customer"),
    (1001, "501 - 1000 Customer"),
    (5001, "1001 - 5000 Customer"),
    (None, "5000+ Customer"),
]

# label -> members
LEAD_SOURCE_CATEGORY = {
    "Core": ["CORE Check-Up", "Free Registration"],
    "Marketing/Community": ["Education", "OSS"],
    "Marketing/Inbound": [
        "CE Download", "Demo", "Drift", "Email Request", "Email Subscription", "Gated Content - General",
        "Gated Content - Report", "Gated Content - Video", "Gated Content - Whitepaper", "Live Event", "Newsletter",
        "Request - Contact", "Request - Professional Services", "Request - Public Sector", "Security Newsletter",
        "Trial - Enterprise", "Virtual Sponsorship", "Web Chat", "Web Direct", "Web", "Webcast",
    ],
    "Marketing/Outbound": ["Advertisement", "Conference", "Field Event", "Owned Event"],
    "Prospecting": [
        "Clearbit", "Datanyze", "Leadware", "LinkedIn", "Prospecting - LeadIQ", "Prospecting - General",
        "Prospecting", "SDR Generated",
    ],
    "Referral": ["Employee Referral", "External Referral", "Partner", "Word of mouth"],
    "Sales": ["AE Generated"],
    "DiscoverOrg": ["DiscoverOrg"],
}
LEAD_SOURCE_BUCKET = {
    "core": ["CORE Check-Up", "CE Download", "CE Usage Ping", "CE Version Check"],
    "inbound": [
        "Consultancy Request", "Contact Request", "Content", "Demo", "Drift", "Education", "EE Version Check", "Email Request",
        "Email Subscription", "Enterprise Trial", "Gated Content - eBook", "Gated Content - General", "Gated Content - Report",
        "Gated Content - Video", "Gated Content - Whitepaper", "Newsletter", "OSS", "Request - Community", "Request - Contact",
        "Request - Professional Services", "Request - Public Sector", "Security Newsletter", "Startup Application", "Web",
        "Web Chat", "White Paper",
    ],
    "outbound": [
        "AE Generated", "Clearbit", "Datanyze", "DiscoverOrg", "Gemnasium", "Gitorious", "gmail", "Leadware", "LinkedIn",
        "Live Event", "Prospecting", "Prospecting - General", "Prospecting - LeadIQ", "SDR Generated", "seamless.ai", "Zoominfo",
    ],
    "paid demand gen": [
        "Advertisement", "Conference", "Executive Roundtable", "Field Event", "Owned Event", "Promotion", "Virtual Sponsorship",
    ],
    "purchased list": ["Purchased List"],
    "referral": [
        "Employee Referral", "Event Partner", "Existing Client", "External Referral", "Partner", "Seminar - Partner", "Word of mouth",
    ],
    "trial": ["Trial - Enterprise"],
    "virtual event": ["Webcast", "Webinar"],
    "web direct": ["Web Direct"],
}
MARKETING_CHANNEL = {
    "Inbound Free Channels": [
        "Other", "Direct", "Organic Search.Bing", "Web Referral", "Social.Twitter", "Social.Other", "Social.LinkedIn",
        "Social.Facebook", "Organic Search.Yahoo", "Organic Search.Google", "Email", "Organic Search.Other",
        "Event.Webcast", "Event.Workshop", "Content.PF Content", "Event.Self-Service Virtual Event",
    ],
    "Inbound Paid": [
        "Event.Virtual Sponsorship", "Paid Search.Other", "Event.Executive Roundtables", "Paid Social.Twitter",
        "Paid Social.Other", "Display.Other", "Paid Search.AdWords", "Paid Search.Bing", "Display.Google",
        "Paid Social.Facebook", "Paid Social.LinkedIn", "Referral.Referral Program", "Content.Content Syndication",
        "Event.Owned Event", "Other.Direct Mail", "Event.Speaking Session", "Content.Gated Content",
        "Event.Field Event", "Other.Survey", "Event.Sponsored Webcast", "Swag.Virtual", "Swag.Direct Mail",
        "Event.Conference", "Event.Vendor Arranged Meetings",
    ],
    "Outbound": ["IQM.IQM"],
    "Trial": ["Trial.Trial"],
}
DEPARTMENT_GROUP = [
    ["Awareness", "Communications", "Community Relations", "Owned Events"],
    ["Brand & Digital Design", "Content Marketing", "Inbound Marketing"],
    ["Campaigns", "Digital Marketing", "Partner Marketing"],
    ["Consulting Delivery", "Customer Success", "Education Delivery", "Practice Management"],
    ["Field Marketing", "Marketing Ops"],
    ["People Success", "CEO"],
    ["Product Management", "Product Strategy"],
    ["Field Ops - Child", "Field Operations"],
]
ACTION_TYPE = {
    1: "created", 2: "updated", 3: "closed", 4: "reopened", 5: "pushed", 6: "commented", 7: "merged", 8: "joined",
    9: "left", 10: "destroyed", 11: "expired",
}
STATE = {1: "opened", 2: "closed", 3: "merged", 4: "locked"}
PIPELINE_FAILURE = {
    0: "unknown_failure", 1: "config_error", 2: "external_validation_failure", 3: "user_not_verified",
    20: "activity_limit_exceeded", 21: "size_limit_exceeded", 22: "job_activity_limit_exceeded",
    23: "deployments_limit_exceeded", 24: "user_blocked", 25: "project_deleted",
}
USER_ROLE = {
    0: "Software Developer", 1: "Development Team Lead", 2: "Devops Engineer", 3: "Systems Administrator",
    4: "Security Analyst", 5: "Data Analyst", 6: "Product Manager", 7: "Product Designer", 8: "Other",
    99: "Experiment Default Value - Signup Not Completed",
}
RESOURCE_EVENT = {1: "added", 2: "removed"}
PRODUCT_RANK = {"Bronze": 1, "Silver": 2, "Gold": 3, "Starter": 1, "Premium": 2, "Ultimate": 3}

# (patterns on the lower-cased text, label), first match wins
ALLIANCE = [
    (["%google%"], "Google Cloud", "GCP"),
    (["%aws%", "%amazon%"], "Amazon Web Services", "AWS"),
    (["%ibm (oem)%"], "IBM (OEM)", "IBM"),
]
PRODUCT_CATEGORY = [
    (["%gold%"], "SaaS - Ultimate"),
    (["%silver%"], "SaaS - Premium"),
    (["%ultimate%"], "Self-Managed - Ultimate"),
    (["%premium%"], "Self-Managed - Premium"),
    (["%bronze%"], "SaaS - Bronze"),
    (["%starter%"], "Self-Managed - Starter"),
    (["plus%"], "Plus"),
    (["standard%"], "Standard"),
    (["basic%"], "Basic"),
    (["%quick start with ha%", "%proserv training per-seat add-on%"], "Support"),
    (["ci runner%"], "SaaS - Other"),
    (["discount%"], "Other"),
]
# The same, blanks before the text ignored.
PRODUCT_CATEGORY_LEADING = [(["githost%"], "GitHost")]
# label -> exact names, blanks around them ignored
PRODUCT_CATEGORY_NAMES = {
    "Trueup": ["Trueup"],
    "Support": [
        "Implementation Services Quick Start", "Implementation Support", "Support Package", "Admin Training", "CI/CD Training",
        "Travel Expenses", "Training Workshop", "InnerSourcing Training - Remote for your team", "Self-Managed Rapid Results Consulting",
        "InnerSourcing Training - At your site", "Migration+", "One Time Discount", "LDAP Integration", "Dedicated Implementation Services",
        "Quick Start without HA, less than 500 users", "Jenkins Integration", "Hourly Consulting", "JIRA Integration",
        "Custom PS Education Services", "Dedicated Engineer - 3 Month (w/ Security Clearance)", "Dedicated Engineer - 12 Month",
        "Dedicated Engineer - 3 Month", "Dedicated Engineer - 6 Month (w/ Security Clearance)", "Dedicated Engineer - 6 Month",
    ],
    "Other": ["Payment Gateway Test", "EdCast Settlement Revenue"],
    "SaaS - Other": ["File Locking", "Time Tracking", "1,000 CI Minutes"],
}
DELIVERY = [
    (["%saas%", "storage", "standard", "basic", "plus"], "SaaS"),
    (["%self-managed%"], "Self-Managed"),
]
DELIVERY_NAMES = {"Others": ["Other", "Support", "Trueup"]}
BACKEND_CATEGORY = [
    (r".*https_git$", "HTTPs Git Data Transfer"),
    (r".*registry$", "Registry Data Transfer"),
    (r".*api$", "API Data Transfer"),
    (r".*web$", "Web Data Transfer"),
    (r".*pages_https?$", "Pages Data Transfer"),
    (r".*websockets$", "WebSockets Data Transfer"),
    (r".*ssh$", "SSH Data Transfer"),
]
JOB_DECIDER_PATTERNS = [
    "%head% it%", "%vp%technology%", "%director%technology%", "%director%engineer%", "%chief%information%",
    "%chief%technology%", "%president%technology%", "%director%development%", "% it%director%",
    "%director%information%", "%director% it%", "%chief%engineer%", "%director%quality%", "%vp%engineer%",
    "%head%information%", "%vp%information%", "%president%information%", "%president%engineer%",
    "%president%development%", "%engineer%director%", "%head%engineer%", "%engineer%head%", "%chief%software%",
    "%director%procurement%", "%procurement%director%", "%head%procurement%", "%procurement%head%",
    "%chief%procurement%", "%vp%procurement%", "%procurement%vp%", "%president%procurement%",
    "%procurement%president%", "%head%devops%",
]
JOB_DECIDER_WORDS = ["cio", "cto", "cfo"]
JOB_MANAGER_PATTERNS = [
    "%manager%information%", "%manager%technology%", "%database%administrat%", "%manager%engineer%",
    "%engineer%manager%", "%information%manager%", "%technology%manager%", "%manager%development%",
    "%manager%quality%", "%manager%network%", "% it%manager%", "%manager% it%", "%manager%systems%",
    "%manager%application%", "%technical%manager%", "%manager%technical%", "%manager%infrastructure%",
    "%manager%implementation%", "%devops%manager%", "%manager%devops%", "%manager%software%",
    "%procurement%manager%", "%manager%procurement%",
]
JOB_WORKER_PATTERNS = [
    "% it %", "% it,%", "%infrastructure%", "%engineer%", "%techno%", "%information%", "%developer%", "%database%",
    "%solutions architect%", "%system%", "%software%", "%technical lead%", "%programmer%",
    "%network administrat%", "%application%", "%procurement%", "%development%", "%tech%lead%",
]
EMAIL_EXCLUDED_PARTS = ["-", "~", "+", "admin", "hack", "xxx", "test"]
BULK_LEAD_SOURCES = ["DiscoverOrg", "Zoominfo", "Purchased List"]
SLA_MINUTES = {"high": 240, "normal": 480, "low": 1440}
SLA_FRIDAY_HOUR = {"high": 20, "normal": 16, "low": 1}
WEEKEND_MINUTES = 2880
URGENT_MINUTES = 30

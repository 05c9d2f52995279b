"""Hand-traced inputs and expected outputs, see FIXTURES.md. None of these come from the code."""

from __future__ import annotations

# input, min, max, currency, type
SALARY_CLEAN = [
    (None, -1, -1, "VND", "negotiable"),
    ("Thoả thuận", -1, -1, "VND", "negotiable"),
    ("Thỏa thuận", -1, -1, "VND", "negotiable"),
    ("thoả thuận", -1, -1, "VND", "unknown"),
    ("10 - 20 triệu", 10, 20, "VND", "range"),
    ("12.5 - 18.5 triệu", 13, 19, "VND", "range"),
    ("20 – 25 triệu", 20, 25, "VND", "range"),
    ("1,000 - 2,000 USD", 26, 52, "USD", "range"),
    ("200000 - 300000 JPY", 33, 50, "JPY", "range"),
    ("Tới 30 triệu", 15, 30, "VND", "upper_bound"),
    ("Upto 1500 USD", 20, 39, "USD", "upper_bound"),
    ("Up to 1,500 USD", 1, 1, "USD", "upper_bound"),
    ("Trên 15 triệu", -1, -1, "VND", "unknown"),
    ("Từ 10 đến 20 triệu", -1, -1, "VND", "unknown"),
    ("10000000 - 20000000 VND", 10000000, 20000000, "VND", "range"),
]

# input, min, max, currency
SALARY_RULES = [
    (None, None, None, None),
    ("Thỏa thuận", None, None, "VND"),
    ("10 - 20 triệu", 10.0, 20.0, "VND"),
    ("13.8 - 34.5 triệu", 13.8, 34.5, "VND"),
    ("Tới 30 triệu", 30.0, 30.0, "VND"),
    ("15000000 - 20000000 VND", 15.0, 20.0, "VND"),
    ("10.000.000 - 15.000.000 VND", 10.0, 15.0, "VND"),
    ("20000000 - 15000000 vnd", 15.0, 20.0, "VND"),
    ("10 - 900 triệu", 10.0, 10.0, "VND"),
    ("1,000 - 2,000 USD", 25.0, 50.0, "USD"),
    ("2k - 3k usd", 50.0, 75.0, "USD"),
    ("60000 usd", None, None, "USD"),
    ("1000 usd/month", None, None, "VND"),
    ("30 man", 30.0, 30.0, "VND"),
    ("200000 yen", 33.0, 33.0, "JPY"),
    ("800 - 1200 eur", 21.6, 32.4, "EUR"),
    ("1500 đô la", 37.5, 37.5, "USD"),
]

# input, exp_min, exp_type, years
EXPERIENCE = [
    (None, -1.0, "unknown", None),
    ("Không yêu cầu", 0.0, "no_requirement", 0.0),
    ("Dưới 1 năm", 0.0, "less_than_1", 0.5),
    ("Dưới 10 năm", 0.0, "less_than_1", 10.0),
    ("2 năm", 2.0, "exact", 2.0),
    ("2 - 3 năm", 3.0, "exact", 2.5),
    ("1,5 năm", 1.5, "exact", 1.5),
    ("Trên 5 năm", 5.0, "exact", 5.0),
    ("2+ years", -1.0, "unknown", 2.0),
    ("6 - 12 tháng", -1.0, "unknown", 0.75),
    ("18 months", -1.0, "unknown", 1.5),
    ("1.5 tháng", -1.0, "unknown", 0.12),
    ("Dưới 6 tháng", -1.0, "unknown", 0.25),
    ("3", -1.0, "unknown", 3.0),
    ("25", -1.0, "unknown", None),
]

# input, date
DEADLINE = [
    (None, None),
    ("Hạn nộp hồ sơ: 31/03/2026", "2026-03-31"),
    ("1/3/2026", "2026-03-01"),
    ("31-03-2026", "2026-03-31"),
    ("2026-03-31", "2026-03-31"),
    ("31/02/2026", None),
    ("Còn 5 ngày", None),
]

# input, stripped location
LOCATION_MARKER = [
    (None, ""),
    ("Hà Nội (mới)", "Hà Nội"),
    ("Hà Nội (MỚI)", "Hà Nội"),
    ("Đà Nẵng (NEW) & 2 nơi khác", "Đà Nẵng & 2 nơi khác"),
    ("Hồ Chí Minh", "Hồ Chí Minh"),
]

# tags, edu, gender, age_min, age_max, languages
REQUIREMENT_TAGS = [
    (None, "unknown", "any", -1, -1, []),
    ([], "unknown", "any", -1, -1, []),
    (["Đại Học trở lên", "Nam", "Tuổi 22 - 35", "Tiếng Anh giao tiếp"],
     "Đại Học trở lên", "Nam", 22, 35, ["Tiếng Anh"]),
    (["Từ 25 tuổi trở lên"], "unknown", "any", 25, -1, []),
    (["Tuổi 22 - 35", "Từ 25 tuổi trở lên"], "unknown", "any", 25, 35, []),
    (["Nam", "Nữ", "Đại học"], "unknown", "Nữ", -1, -1, []),
    (["Tiếng Anh", "Tiếng Nhật N2", "Tiếng Đức"], "unknown", "any", -1, -1,
     ["Tiếng Anh", "Tiếng Nhật", "Tiếng Đức"]),
]

# tags, verdict
IT_VERDICT = [
    (None, "none"),
    ([], "none"),
    (["Foo"], "none"),
    ([" backend developer "], "true"),
    (["Backend Developer", "Sales"], "false"),
]

# input, city, mart bucket of the raw text (None: the mart drops the row)
CITY = [
    (None, "Khác", None),
    ("Hà Nội", "Hà Nội", "Hà Nội"),
    ("Hồ Chí Minh & 2 nơi khác", "TP.HCM", "Hồ Chí Minh"),
    ("Hà Nội, Hồ Chí Minh", "TP.HCM", "Hà Nội"),
    ("TP.HCM", "TP.HCM", "Khác"),
    ("Bình Dương", "TP.HCM", "Khác"),
    ("Huế", "Khác", "Khác"),
    ("DN", "Đà Nẵng", "Khác"),
    ("ĐN", "Đồng Nai", "Khác"),
    ("Toàn quốc", "Remote", "Toàn quốc"),
    ("Remote", "Remote", "Khác"),
]

# title, experience, level
LEVEL_RULES = [
    ("Senior Java Developer", "2 năm", "Senior"),
    ("Product Manager", "3 năm", "Manager"),
    ("Tech Lead", None, "Lead"),
    ("Java Developer", "2.5 năm", "Senior"),
    ("Java Developer", "Dưới 2 năm", "Middle"),
    ("Java Developer", "1 năm", "Junior"),
    ("Java Developer", "12 năm", None),
    ("Fresher React", None, "Fresher"),
    (None, "5 năm", None),
]

# title, exp_min, level
LEVEL_TITLE = [
    ("Senior Manager", 1.0, "Senior"),
    ("Tech Lead", None, "Lead"),
    ("International Sales", 5.0, "Intern"),
    ("Java Developer", 8.0, "Senior"),
    ("Java Developer", 3.0, "Middle"),
    ("Java Developer", 0.0, "Junior"),
    ("Java Developer", -1.0, "Unknown"),
    (None, None, "Unknown"),
    ("Quản lý dự án", 2.0, "Manager"),
]

# title, description, domains, is_it
DOMAINS = [
    (None, None, ["Other"], False),
    ("Kế toán trưởng", None, ["Other"], False),
    ("Senior Data Engineer (Python)", None, ["Data Engineer"], True),
    ("IT BA / Scrum Master", None, ["Business Analyst", "Scrum Master"], True),
    ("UI/UX Designer", None, ["UI/UX Designer"], True),
    (None, '<li class="data engineer">Java developer</li>', ["Backend Developer"], True),
]

# domains, title, skills
SKILLS = [
    (["Backend Developer"], "Java / Spring Boot, C# .NET, ASP.NET, REST API",
     [".NET", "C#", "Java", "REST API", "Spring Boot"]),
    (["IoT/Embedded"], "C# và C++, ESP32", ["C", "C++", "ESP32"]),
    (["AI Scientist"], "R&D python", ["Python", "R"]),
    (["Other"], "Java Python", []),
    (None, "Java Python", []),
]

# reply, verdict, domain, skills, is_it, exp_max, locations, max_salary_verified
REPLIES = [
    ('```json\n{"domain":"DevOps","technical_skills":["Docker"],"exp_max":5,'
     '"max_salary_verified":0}\n```', "none", "DevOps", ["Docker"], True, 5.0, [], -1),
    ("{}", "none", "Other", [], False, -1.0, [], -1),
    ("not json", "true", "Other", [], True, -1.0, [], -1),
    ('{"domain":"DevOps"}', "false", "DevOps", [], False, -1.0, [], -1),
]

# html, text
HTML_TEXT = [
    (None, ""),
    ("<p>Mô tả:</p><ul><li>Code &amp; test</li><li>Review</li></ul>",
     "Mô tả:\n• Code & test\n• Review"),
    ("a<br><br/><br />b", "a\n\nb"),
    ("&lt;b&gt;x", "<b>x"),
    ("<script>t=1</script>z", "t=1z"),
]

# alias, canonical name
ALIASES = [
    ("pyspark", "Spark"), ("Apache Kafka", "Kafka"), ("springboot", "Spring Boot"),
    ("spring-boot", "Spring Boot"), ("ReactJS", "React"), ("React.js", "React"),
    ("next js", "Next.js"), ("nodejs", "Node.js"), ("k8s", "Kubernetes"), ("cicd", "CI/CD"),
    ("ci-cd", "CI/CD"), ("c#", "C#"), ("csharp", "C#"), ("cpp", "C++"), ("GIT", "Git"),
    ("Mongo DB", "MongoDB"), ("iso27001", "ISO 27001"), ("big query", "BigQuery"),
    ("reactnative", "React Native"), ("Cobol", "Cobol"),
]


def keywords(vocabulary: dict) -> list[tuple[str, str]]:
    """Every (label, keyword) of a vocabulary, in its order."""
    return [(label, word) for label, words in vocabulary.items() for word in words]

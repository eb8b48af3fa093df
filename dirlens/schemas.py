"""Column orders and types of the tables that the operators exchange; fixed values."""

LEAD = ("district", "school", "first_name", "last_name", "email", "role", "lead_type")
LEAD_HEADERS = {"district": "District", "school": "School", "first_name": "First Name", "last_name": "Last Name", "email": "Email", "role": "Role", "lead_type": "Lead Type"}
EMPLOYEE = (
    "district", "school", "name", "first_name", "last_name", "title", "department", "email", "phone", "extension", "room",
    "office", "subjects", "grade", "biography", "photo_url", "profile_url", "school_url", "directory_url", "employee_type",
    "lead_type", "scraped_at",
)
DISTRICT = ("district_number", "district_name", "county", "region", "website")
DIRECTORY_LINK = (*DISTRICT, "staff_directory_url", "method", "status")
PROFILE = ("district_name", "website", "staff_directory_url", "cms", "generator", "vendor_host", "dir_style", "austin_like", "n_mailto", "n_table_rows", "n_cards", "notes")
#: The page store: what has been fetched, by address and variant (static, rendered, modal).
PAGE = "url string, html string, status int, content_type string, variant string"

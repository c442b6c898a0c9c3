"""A table of job postings made from ``documents``, for the queries: the same SQL in Spark and DuckDB."""

from __future__ import annotations


def quote(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "''") + "'"


def pick(step: str, values: list[str | None]) -> str:
    """One of the values by ``step`` modulo their number."""
    cases = " ".join(f"WHEN {k} THEN {quote(v)}" for k, v in enumerate(values))
    return f"CASE ({step}) % {len(values)} {cases} END"


TITLES = [
    "Optimization Engineer", "SEO Optimization Lead", "Planner", "Barista", "", None, "Senior Data Scientist", "Director of Analytics", "Supply Chain Analyst", "Junior Routing Developer",
    "Project Coordinator", "International Sales Manager", "Principal Scientist", "Chief Algorithm Officer", "Associate Consultant", "Machine Learning Intern", "Head of Logistics", "Staff Engineer", "Scheduling Solver Specialist",
]
PHRASES = [
    "We use Gurobi and CPLEX for vehicle routing and scheduling.", "MILP and demand planning with Pyomo, PuLP or OR-Tools.", "Requires a PhD in operations research and statistics.", "Bachelor's degree in computer science.", "Plain text.",
    "Full-time role, mixed integer programming, heuristic search, genetic algorithm.", "6 month contract in logistics and supply chain management.", "Experience with Python, R and SQL; Tableau a plus.", "", "MBA or finance background for the retail industry.",
    "Postdoctoral research associate at a national lab.", "Part time nursing position, high school or GED.", "Optimization optimization OPTIMIZATION, simplex, interior point, branch and bound.", "Apache Airflow, MLflow, Docker and Kubernetes.", "Undergraduate degree; teaching assistant welcome.",
    "Internship in industrial engineering with lean six sigma.", "Stochastic optimization, convex optimization, inventory optimization and metaheuristic methods.",
]
COMPANIES = ["Acme Software", "University of Examples", "Nordic Bank", "Example Logistics GmbH", "", None, "Auto Parts Inc", "Health Clinic", "Research Centre North", "Retail Digital", "State Energy"]
LEVELS = ["Mid-Senior level", "mid-senior level", "Not Applicable", "Entry level", "Internship", "Director", "Associate", "", None, "Executive", "NA", "gibberish", "Senior"]
FUNCTIONS = ["Engineering and Information Technology", "Research, Analyst, and Information Technology", "Supply Chain", "", None, "Finance and Sales", "Consulting", "Education, Training", "Other", "Management and Manufacturing"]
TYPES = ["fulltime", "parttime, fulltime", "temporary", "volunteer", "", None, "internship", "contract"]
FIELDS = ["Software Development", "Hospitals and Health Care", "", None, "Banking", "Truck Transportation", "Oil and Gas", "Higher Education", "Motor Vehicle Manufacturing", "Food and Beverage Services", "Government Administration", "Staffing"]
TERMS = ["operations research", "supply chain", "optimization", "data scientist", "logistics"]
COUNTRIES = ["germany", "france", "spain", "uk", "", "unknown", None]
SKILLS = ["Python, Soft Skills, Gurobi", "SQL, Excel", "", None, "Machine Learning, R", "Gurobi"]
TOOLS = ["Gurobi", "", None, "Python", "CPLEX, R"]
POSTED = ["2024-01-15", "2024-01-31T10:00:00Z", "2023-11-02T08:30:00", "unknown", "", None, "2024-02-01", "2023-12-31"]

JOBS = f"""
SELECT doc_id AS id, concat('job_', CAST(doc_id AS STRING)) AS job_id,
  CASE WHEN doc_id % 3 = 0 THEN 'linkedin' ELSE 'indeed' END AS platform,
  {pick("doc_id", TITLES)} AS actual_role,
  CASE WHEN doc_id % 97 = 5 THEN NULL WHEN doc_id % 89 = 7 THEN '' ELSE concat({pick("doc_id", PHRASES)}, ' ', text) END AS job_description,
  {pick("doc_id + doc_id / 7", COMPANIES).replace("/ 7", "% 7")} AS company_name,
  {pick("doc_id", COUNTRIES)} AS country, {pick("doc_id", TERMS)} AS search_term,
  CASE WHEN doc_id % 41 = 3 THEN '' ELSE concat(CASE WHEN doc_id % 2 = 0 THEN 'http://x.example/' ELSE 'HTTP://X.example/' END, CAST(doc_id % 730 AS STRING), CASE WHEN doc_id % 5 = 0 THEN '/' ELSE '' END) END AS url,
  CASE WHEN doc_id % 50 = 0 THEN concat('http://c.example/', CAST(doc_id % 350 AS STRING)) ELSE '' END AS company_url,
  {pick("doc_id", POSTED)} AS posted_text, concat('2024-02-0', CAST(1 + doc_id % 5 AS STRING), 'T00:00:00') AS scraped_at,
  {pick("doc_id", LEVELS)} AS job_level, {pick("doc_id", FUNCTIONS)} AS job_function, {pick("doc_id", TYPES)} AS job_type,
  {pick("doc_id", FIELDS)} AS company_industry, {pick("doc_id", SKILLS)} AS skills, {pick("doc_id", TOOLS)} AS tools, lang AS language,
  CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS is_remote
FROM documents
"""

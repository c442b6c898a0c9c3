"""Vocabularies. Word lists, names and patterns that results depend on."""

TITLE_KEYWORDS = ["optim", "operations research", "supply chain", "logistics", "routing", "scheduling", "decision science", "algorithm", "data scientist", "machine learning", "analytics", "solver", "mathematical"]

STRONG_KEYWORDS = [
    "operations research", "linear programming", "integer programming", "mixed integer", "milp", "gurobi", "cplex", "or-tools", "ortools",
    "constraint programming", "combinatorial optimization", "mathematical optimization", "network optimization", "vehicle routing",
    "scheduling optimization", "supply chain optimization", "inventory optimization", "heuristic", "metaheuristic", "convex optimization",
    "stochastic optimization", "discrete optimization", "pulp", "pyomo", "Industrial Engineering", "Fulfillment Optimization", "demand planning",
]

NEGATIVE_KEYWORDS = ["seo", "search engine", "sales optimization", "marketing optimization", "conversion optimization", "website optimization", "social media", "content optimization", "ad optimization", "campaign optimization"]

FREQUENCY_KEYWORDS = [
    "gurobi", "cplex", "pyomo", "or-tools", "ortools", "pulp", "scipy", "cvxpy", "gekko", "amplpy", "mosek", "xpress", "cbc", "glpk", "scip",
    "optimization", "optimisation", "linear programming", "integer programming", "mixed integer", "milp", "mip", "quadratic programming",
    "convex optimization", "combinatorial optimization", "constraint programming", "stochastic optimization", "dynamic programming",
    "network optimization", "vehicle routing", "scheduling", "heuristic", "metaheuristic", "genetic algorithm", "simulated annealing",
    "tabu search", "branch and bound", "simplex", "interior point", "operations research", "operational research", "mathematical modeling",
    "decision science", "prescriptive analytics",
]

PREMIUM_KEYWORDS = ["optim"]

EDUCATION_LEVELS = {
    "PhD": [r"\bph\.?d\.?\b", r"\bdoctora(l|te)\b", r"\bdoctor\s+of\s+philosophy\b", r"\bdr\.\s*(of\s+)?(engineering|science)\b"],
    "Master": [r"\bmaster'?s?\b", r"\bm\.?s\.?\b(?!\s*office)", r"\bm\.?sc\.?\b", r"\bm\.?a\.?\b(?!\s+position)", r"\bm\.?eng\.?\b", r"\bmba\b", r"\bgraduate\s+degree\b"],
    "Bachelor": [r"\bbachelor'?s?\b", r"\bb\.?s\.?\b(?!\s*in\s+business)", r"\bb\.?sc\.?\b", r"\bb\.?a\.?\b(?!\s+position)", r"\bb\.?eng\.?\b", r"\bundergraduate\s+degree\b", r"\b4[\-\s]?year\s+degree\b"],
    "Associate": [r"\bassociate'?s?\s+degree\b", r"\ba\.?s\.?\s+degree\b", r"\b2[\-\s]?year\s+(college\s+)?degree\b"],
    "High School": [r"\bhigh\s+school\b", r"\bged\b", r"\bhighschool\b", r"\bsecondary\s+(school\s+)?education\b"],
}

#: The narrower table with which missing levels are filled.
EDUCATION_FILL = {
    "PhD": [r"\bph\.?d\.?\b", r"\bdoctora(l|te)\b", r"\bdoctor\s+of\s+philosophy\b"],
    "Master": [r"\bmaster'?s?\b", r"\bm\.?s\.?\b(?!\s*office)", r"\bm\.?sc\.?\b", r"\bmba\b", r"\bgraduate\s+degree\b"],
    "Bachelor": [r"\bbachelor'?s?\b", r"\bb\.?s\.?\b", r"\bb\.?sc\.?\b", r"\bundergraduate\s+degree\b", r"\b4[\-\s]?year\s+degree\b"],
    "Associate": [r"\bassociate'?s?\s+degree\b", r"\b2[\-\s]?year\s+degree\b"],
    "High School": [r"\bhigh\s+school\b", r"\bged\b"],
}

EDUCATION_FIELDS = {
    "Industrial Engineering": [
        r"\bindustrial\s+engineer(ing)?\b", r"\bmanufacturing\s+engineer(ing)?\b", r"\boperations\s+research\b", r"\bproduction\s+engineer(ing)?\b",
        r"\bsystems\s+engineer(ing)?\b", r"\bprocess\s+engineer(ing)?\b", r"\bquality\s+engineer(ing)?\b", r"\bsupply\s+chain\s+(management|engineer(ing)?)\b",
        r"\bwork\s+study\b", r"\bergonomics\b", r"\bie\s+degree\b", r"\blean\s+(manufacturing|six\s+sigma)\b",
    ],
    "Other Engineering": [
        r"\b(mechanical|electrical|civil|chemical|software|computer|aerospace|biomedical|environmental|materials|nuclear|petroleum|agricultural|marine|mining|structural|automotive|robotics)\s+engineer(ing)?\b",
        r"\bengineering\s+(degree|background|discipline)\b", r"\bengineer(ing)?\s+(field|major|program)\b",
    ],
    "Computer Science": [r"\bcomputer\s+science\b", r"\bcs\s+degree\b", r"\binformatics\b", r"\bsoftware\s+development\b", r"\bdata\s+science\b", r"\bai\b", r"\bmachine\s+learning\b", r"\bartificial\s+intelligence\b"],
    "Business": [r"\bbusiness\s+(administration|management)\b", r"\bmba\b", r"\bfinance\b", r"\baccounting\b", r"\bmarketing\b", r"\beconomics\b", r"\bmanagement\s+(degree|background)\b"],
    "Mathematics and Statistics": [
        r"\bmathematics\b", r"\bmath\s+degree\b", r"\bstatistics\b", r"\bstatistical\s+(analysis|methods)\b", r"\bapplied\s+math(ematics)?\b",
        r"\bcomputational\s+math(ematics)?\b", r"\bquantitative\s+(methods|analysis)\b",
    ],
    "Science": [r"\b(physics|chemistry|biology)\b", r"\bnatural\s+science\b", r"\blife\s+science\b", r"\bstem\b"],
    "Medicine": [r"\bmedicine\b", r"\bmedical\s+degree\b", r"\bmd\s+degree\b", r"\bphysician\b", r"\bdoctor\s+of\s+medicine\b"],
    "Healthcare/Nursing": [r"\bnursing\b", r"\bnurse\b", r"\brn\s+degree\b", r"\bpharmacy\b", r"\bpharmacist\b", r"\bhealthcare\s+management\b", r"\bpublic\s+health\b", r"\bhealth\s+administration\b"],
}

RESEARCH_PATTERNS = [
    r"\bprofessor\b", r"\bassociate\s+professor\b", r"\bassistant\s+professor\b", r"\blecturer\b", r"\bsenior\s+lecturer\b", r"\bteaching\s+assistant\b",
    r"\bresearch\s+(fellow|associate|scientist|assistant)\b", r"\bpostdoc(toral)?\b", r"\bpost[\-\s]?doc(toral)?\b", r"\bfaculty\s+(position|member)\b",
    r"\btenure[\-\s]?track\b", r"\bacademic\s+(position|role|career)\b", r"\buniversity\s+(position|role)\b", r"\bphd\s+(student|candidate|position)\b",
    r"\bdoctoral\s+(student|candidate)\b", r"\bresearch\s+chair\b", r"\bendowed\s+chair\b", r"\bdean\b", r"\bdepartment\s+(head|chair)\b",
    r"\bprincipal\s+investigator\b", r"\blab\s+(director|manager|head)\b", r"\bvisiting\s+(scholar|professor|researcher)\b",
]

ACADEMIC_NAMES = ["university", "college", "institute", "school of", "faculty", "department of", "research center", "research centre", "laboratory", "national lab", "academy", "polytechnic"]

BOILERPLATE = [
    r"equal\s+opportunity\s+employer[^.]*\.", r"we\s+are\s+an?\s+equal\s+opportunity[^.]*\.", r"eoe[\s/,\-]*(m/f|minority|disability|veteran|protected)[^.]*\.",
    r"all\s+qualified\s+applicants\s+will\s+receive\s+consideration[^.]*\.", r"we\s+do\s+not\s+discriminate[^.]*\.", r"(affirmative\s+action|aa)\s*/?\s*(equal\s+opportunity|eoe)[^.]*\.",
    r"#{1,4}\s*about\s+(the\s+)?company.*?(?=#{1,4}|\Z)", r"#{1,4}\s*about\s+us.*?(?=#{1,4}|\Z)", r"#{1,4}\s*who\s+we\s+are.*?(?=#{1,4}|\Z)",
    r"\*{2}about\s+(the\s+)?company\*{2}.*?(?=\*{2}[a-z]|\Z)", r"\*{2}about\s+us\*{2}.*?(?=\*{2}[a-z]|\Z)",
    r"privacy\s+(policy|notice)[^.]*\.", r"cookie\s+(policy|notice|preferences)[^.]*\.", r"by\s+(applying|submitting)[^.]*consent[^.]*\.",
    r"click\s+(here\s+)?to\s+apply[^.]*\.", r"apply\s+now[^.]*\.", r"to\s+apply[,:]?\s+(please\s+)?(submit|send|visit|click)[^.]*\.",
    r"this\s+job\s+(posting|description)\s+(is|may)[^.]*\.", r"salary\s+(range|information)[^.]*\.", r"compensation[^.]*\$[\d,]+[^.]*\.",
]

JOB_TYPES = {
    "Full-time": ["fulltime", "full-time", "full time", "permanent", "fte", "regular"],
    "Part-time": ["parttime", "part-time", "part time", "pte"],
    "Contract": ["contract", "contractor", "consulting", "freelance", "temporary", "temp"],
    "Internship": ["intern", "internship", "co-op", "coop", "trainee", "apprentice"],
}

JOB_TYPE_PATTERNS = {
    "Full-time": r"\b(full[\s\-]?time|permanent|fte)\b",
    "Part-time": r"\b(part[\s\-]?time|pte)\b",
    "Contract": r"\b(contract(or)?|consulting|freelance|temporary|temp\b)",
    "Internship": r"\b(intern(ship)?|co[\s\-]?op|trainee|apprentice)\b",
}

#: Exact values (lower case) first; then substrings, in order; everything else is not specified.
LEVEL_VALUES = {
    "internship": "Internship", "entry level": "Entry Level", "associate": "Not Specified", "mid-level": "Mid-Level", "mid level": "Mid-Level",
    "senior": "Senior", "senior level": "Senior", "mid-senior level": "Senior", "director": "Director", "executive": "Executive",
    "not applicable": "Not Specified", "": "Not Specified",
}

LEVEL_KEYWORDS = {
    "Internship": ["internship", "intern"],
    "Entry Level": ["entry level", "entry-level", "graduate", "junior", "fresher"],
    "Associate": ["associate"],
    "Mid-Level": ["mid-level", "mid level", "intermediate"],
    "Senior": ["senior", "sr.", "lead", "principal", "staff", "mid-senior level"],
    "Director": ["director", "head of", "vp", "vice president"],
    "Executive": ["executive", "c-level", "chief", "cto", "ceo", "cfo", "coo"],
}

JOB_FUNCTIONS = {
    "Engineering": ["engineering", "software", "hardware", "developer", "programmer", "engineering and information technology", "information technology and engineering"],
    "Data Science & Analytics": ["data science", "analytics", "analyst", "data analyst", "business intelligence", "research, analyst", "analyst,"],
    "Operations Research": ["operations research", "optimization", "or specialist"],
    "Research & Development": ["research", "r&d", "scientist", "research and engineering", "science and research"],
    "Supply Chain & Logistics": ["supply chain", "logistics", "procurement", "purchasing", "distribution", "manufacturing", "production", "quality assurance"],
    "Information Technology": ["information technology", "it ", "it services", "infrastructure", "network", "systems admin"],
    "Product Management": ["product management", "product manager", "product owner"],
    "Business & Finance": ["finance", "accounting", "business", "investment", "banking", "accounting/auditing"],
    "Consulting": ["consulting", "consultant", "advisory"],
    "Sales & Marketing": ["sales", "marketing", "business development", "customer"],
    "Healthcare": ["health care", "healthcare", "medical", "clinical", "nursing"],
    "Education": ["education", "training", "teaching", "academic"],
    "Management": ["management", "manager", "administrative", "strategy"],
}

INDUSTRIES = {
    "Technology & Software": ["software", "internet", "technology", "it services", "computer", "information services", "saas", "cloud", "digital"],
    "Healthcare & Pharmaceuticals": ["health care", "healthcare", "pharmaceutical", "biotech", "medical", "hospital", "clinical", "life science"],
    "Finance & Banking": ["financial", "banking", "insurance", "investment", "fintech", "capital", "asset management"],
    "Manufacturing & Industrial": ["manufacturing", "industrial", "production", "machinery", "equipment", "appliances", "electrical", "electronics"],
    "Retail & E-commerce": ["retail", "e-commerce", "ecommerce", "consumer goods", "marketplace"],
    "Consulting & Professional Services": ["consulting", "professional services", "business services", "advisory", "human resources"],
    "Transportation & Logistics": ["transportation", "logistics", "shipping", "freight", "airline", "aviation", "ground passenger"],
    "Energy & Utilities": ["energy", "oil", "gas", "utilities", "power", "renewable", "nuclear", "electric"],
    "Telecommunications": ["telecom", "telecommunications", "wireless", "network"],
    "Education & Research": ["education", "school", "university", "research services", "academic"],
    "Government & Public Sector": ["government", "public sector", "federal", "state", "municipal"],
    "Aerospace & Defense": ["aerospace", "defense", "space", "military", "aviation and aerospace"],
    "Automotive": ["automotive", "motor vehicle", "car", "auto"],
    "Food & Beverage": ["food", "beverage", "restaurant", "hospitality"],
}

TOOLS = {
    "Optimization Solvers": {
        "Gurobi": [r"\bgurobi\b"], "CPLEX": [r"\bcplex\b", r"\bibm\s+ilog\s+cplex\b"], "MOSEK": [r"\bmosek\b"], "Xpress": [r"\bxpress\b"], "CBC": [r"\bcbc\b"],
        "GLPK": [r"\bglpk\b"], "SCIP": [r"\bscip\b"], "Concorde": [r"\bconcorde\b"], "LocalSolver": [r"\blocalsolver\b"],
    },
    "Modeling Languages": {"GAMS": [r"\bgams\b"], "AMPL": [r"\bampl\b"]},
    "Optimization Libraries": {
        "Pyomo": [r"\bpyomo\b"], "OR-Tools": [r"\bor-tools\b", r"\bortools\b"], "PuLP": [r"\bpulp\b"], "CVXPY": [r"\bcvxpy\b"], "Gekko": [r"\bgekko\b"],
        "SciPy Optimize": [r"\bscipy\.optimize\b", r"\bscipy\s+optimize\b", r"\bscipy\.optim\b"], "OptaPlanner": [r"\boptaplanner\b"],
        "Metaheuristics": [r"\bmetaheuristics?\b", r"\bheuristic\b", r"\bgenetic\s+algorithms?\b", r"\bsimulated\s+annealing\b", r"\btabu\s+search\b", r"\bparticle\s+swarm\b", r"\bant\s+colony\b"],
    },
    "MLOps & Workflow Tools": {"MLflow": [r"\bmlflow\b"], "Apache Airflow": [r"\bapache\s+airflow\b", r"\bairflow\b"]},
    "Programming Languages": {
        "Python": [r"\bpython\b"],
        "R": [
            r"\br\s+programming\b", r"\br\s+language\b", r"\br\s+studio\b", r"\brstudio\b", r"\br\s*\(programming\)\b", r"\bprogramming\s+in\s+r\b", r"\bexperience\s+(with|in)\s+r\b",
            r"\bproficiency\s+in\s+r\b", r"\bpython,\s*r\b", r"\br,\s*python\b", r"\br/python\b", r"\bpython/r\b", r"\bstatistical\s+software.*\br\b", r"\bknowledge\s+of\s+r\b",
        ],
    },
}

#: Names that older rows carry as skills although they are tools.
LEGACY_TOOLS = ["Pyomo", "OR-Tools", "GAMS", "AMPL", "CPLEX", "Gurobi", "Python", "R"]

#: Skills by category, each with the phrases that name it, in lower case.  A phrase that
#: holds another of the same skill says nothing new and is left out.
SKILLS = {
    "Natural Language Processing": {
        "Natural Language Processing": ["natural language processing", "nlp", "ner", "text classification", "sentiment analysis"],
    },
    "Generative AI": {
        "Generative AI": ["generative ai", "large language models", "llms", "gpt", "transformers"],
    },
    "Programming Languages": {
        "SQL": ["sql"],
        "Java": ["java"],
        "JavaScript": ["javascript"],
        "TypeScript": ["typescript"],
        "Go": ["golang", "go programming", "go language", "programming in go", "experience with go", "experience in go"],
        "C#": ["c#"],
        "C++": ["c++"],
        "C": ["c programming", "c language", "c/c++", "c, c++", "c,c++", "programming in c", "experience with c", "experience in c", "c and c++"],
        "Rust": ["rust"],
        "Scala": ["scala"],
        "Kotlin": ["kotlin"],
        "Swift": ["swift"],
        "PHP": ["php"],
        "Ruby": ["ruby"],
    },
    "Data Science & Analytics": {
        "Data Analysis": ["data analysis", "ad-hoc analysis", "statistical analysis"],
        "Data Visualization": ["data visualization", "data storytelling", "dashboards", "reporting"],
        "Business Analytics": ["business analytics", "product analytics", "customer analytics", "marketing analytics"],
        "Predictive Analytics": ["predictive analytics", "prescriptive analytics", "descriptive analytics"],
        "A/B Testing": ["a/b testing", "experimental design", "hypothesis testing"],
    },
    "Machine Learning": {
        "Machine Learning": ["machine learning", "ml", "supervised learning", "unsupervised learning"],
        "Deep Learning": ["deep learning", "neural networks", "cnns", "rnn", "lstm"],
        "Computer Vision": ["computer vision", "ocr", "yolo", "image processing"],
        "Reinforcement Learning": ["reinforcement learning", "rl", "rlhf"],
    },
    "Optimization & Operations Research": {
        "Mathematical Programming": ["mathematical programming", "linear programming", "integer programming", "mixed integer"],
    },
    "Statistics & Probability": {
        "Statistics": ["statistics", "statistical analysis", "statistical modeling", "statistical inference"],
        "Probability Theory": ["probability theory", "bayesian statistics", "stochastic processes"],
        "Regression Analysis": ["regression analysis", "regression"],
        "Time Series Analysis": ["time series analysis", "time series", "forecasting", "trend analysis"],
    },
    "Databases & Data Storage": {
        "PostgreSQL": ["postgresql", "postgres"],
        "MySQL": ["mysql"],
        "MongoDB": ["mongodb"],
        "Redis": ["redis"],
        "Elasticsearch": ["elasticsearch"],
        "NoSQL": ["nosql", "cassandra", "dynamodb", "couchdb", "neo4j"],
        "Vector Databases": ["vector database", "pinecone", "weaviate", "qdrant", "faiss", "chroma"],
    },
    "Big Data & Distributed Systems": {
        "Apache Spark": ["apache spark", "spark sql", "spark dataframe", "spark streaming", "pyspark"],
        "Hadoop": ["hadoop", "hdfs", "mapreduce", "yarn"],
        "Apache Kafka": ["apache kafka", "kafka", "stream processing"],
        "Big Data": ["big data", "apache flink", "apache beam", "apache airflow"],
    },
    "Cloud & DevOps": {
        "AWS": ["aws", "amazon web services"],
        "Azure": ["azure"],
        "Google Cloud Platform": ["google cloud platform", "gcp", "bigquery", "vertex ai", "google cloud functions"],
        "Docker": ["docker", "containerization"],
        "Kubernetes": ["kubernetes", "k8s", "helm", "kubeflow"],
        "CI/CD": ["ci/cd", "jenkins", "github actions", "gitlab ci", "travis ci", "circleci"],
        "Terraform": ["terraform", "infrastructure as code", "iac"],
        "DevOps": ["devops", "ansible", "puppet", "chef", "monitoring", "prometheus", "grafana"],
    },
    "Backend Development": {
        "Node.js": ["node.js", "nodejs"],
        "Express.js": ["express.js", "express"],
        "Django": ["django"],
        "Flask": ["flask"],
        "FastAPI": ["fastapi"],
        "Spring Framework": ["spring framework", "spring"],
        ".NET": [".net", "asp.net"],
        "Ruby on Rails": ["ruby on rails", "rails"],
    },
    "Frontend Development": {
        "React": ["react", "redux", "zustand"],
        "Vue.js": ["vue.js", "vue"],
        "Angular": ["angular"],
        "Next.js": ["next.js", "nextjs"],
        "Frontend Technologies": ["html5", "css3", "tailwind css", "bootstrap", "sass", "less", "webpack", "vite"],
        "Mobile Development": ["mobile development", "ios development", "android development", "flutter", "react native"],
    },
    "Software Engineering Practices": {
        "Git": ["git", "github", "gitlab", "version control", "source control"],
        "Testing": ["unit testing", "jest", "pytest", "junit", "selenium", "cypress"],
        "Agile Methodology": ["agile methodology", "scrum", "kanban", "jira"],
        "Code Quality": ["code review", "solid principles", "design patterns", "refactoring"],
    },
    "APIs & Integration": {
        "REST API": ["rest api", "restful", "api design", "http"],
        "GraphQL": ["graphql"],
        "Microservices": ["microservices", "service mesh", "api gateway"],
        "Message Queues": ["message queues", "rabbitmq", "activemq", "apache kafka"],
    },
    "Data Engineering": {
        "Data Pipelines": ["data pipelines", "etl", "elt", "data orchestration"],
        "Apache Airflow": ["apache airflow", "airflow", "workflow orchestration"],
        "dbt": ["dbt", "data build tool", "data transformation"],
        "Data Warehousing": ["data warehousing", "data warehouse", "dimensional modeling", "star schema"],
        "Data Quality": ["data quality", "data validation", "data profiling", "great expectations"],
    },
    "Visualization & BI": {
        "Tableau": ["tableau"],
        "Power BI": ["power bi", "powerbi", "dax"],
        "Looker": ["looker", "lookml"],
        "Visualization Libraries": ["matplotlib", "seaborn", "plotly", "d3.js", "ggplot2", "streamlit", "gradio"],
        "Excel": ["excel", "vlookup", "xlookup", "pivot tables", "power query"],
    },
    "Mathematical Modeling": {
        "Mathematical Modeling": ["mathematical modeling", "optimization modeling", "simulation modeling"],
        "Simulation": ["simulation", "monte carlo"],
    },
    "AI & Advanced Modeling": {
        "LLM Operations": ["llmops", "prompt engineering", "fine-tuning", "rag", "retrieval augmented generation"],
        "AI Frameworks": ["langchain", "llamaindex", "hugging face", "openai", "anthropic", "claude", "gemini"],
        "MLOps": ["mlops", "model deployment", "model monitoring", "mlflow", "kubeflow"],
    },
    "Research & Scientific Computing": {
        "Scientific Computing": ["scientific computing", "numpy", "scipy", "pandas", "jupyter"],
        "Research Methods": ["research methods", "experimental design", "causal inference", "user research"],
        "Technical Writing": ["technical writing", "documentation", "public speaking"],
    },
    "Product & Business Knowledge": {
        "Product Management": ["product management", "product roadmapping", "user stories", "requirements gathering"],
        "Business Intelligence": ["business intelligence", "business analytics", "kpi tracking", "metrics analysis"],
        "Domain Knowledge": ["domain knowledge", "business acumen", "industry knowledge", "market research"],
    },
    "Soft & Managerial Skills": {
        "Leadership": ["leadership", "team management", "mentoring", "coaching"],
        "Communication": ["communication", "presentation skills", "stakeholder management", "active listening"],
        "Problem Solving": ["problem solving", "critical thinking", "analytical thinking", "decision making"],
        "Project Management": ["project management", "agile", "scrum", "prince2", "pmp"],
    },
    "Security & Compliance": {
        "Cybersecurity": ["cybersecurity", "information security", "network security", "cloud security"],
        "Security Testing": ["security testing", "penetration testing", "vulnerability assessment", "sast", "dast"],
        "Compliance": ["compliance", "gdpr", "hipaa", "soc 2"],
    },
}

LANGUAGE_NAMES = {
    "en": "English", "de": "German", "fr": "French", "es": "Spanish", "it": "Italian", "nl": "Dutch", "pt": "Portuguese", "da": "Danish", "sv": "Swedish", "no": "Norwegian",
    "fi": "Finnish", "pl": "Polish", "cs": "Czech", "hu": "Hungarian", "ro": "Romanian", "ru": "Russian", "zh": "Chinese", "ja": "Japanese", "ko": "Korean", "ar": "Arabic", "hi": "Hindi", "NA": "Not Detected",
}

#: Function words by which the built-in detector tells languages apart.
FUNCTION_WORDS = {
    "en": ["the", "and", "of", "to", "in", "that", "for", "with", "was"],
    "de": ["der", "die", "und", "das", "von", "nicht", "ist", "ein", "mit"],
    "fr": ["les", "des", "est", "une", "dans", "pour", "que", "avec", "sur"],
    "es": ["los", "del", "las", "por", "una", "para", "con", "que", "como"],
    "nl": ["het", "een", "van", "niet", "zijn", "voor", "met", "dat", "ook"],
}

NA = "NA"

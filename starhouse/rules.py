"""Fixed values of the warehouse: word lists, lookup tables, weights and ranges.

Everything in this module is data that the results depend on.  The functions that
apply it live in ``starhouse.functions``.
"""

from __future__ import annotations

# --- Fixed values: text tokens that mean "no value" in a landed CSV file -------------------
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Fixed values: white space as stripped around parsed text fields -----------------------
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# --- Fixed values: CSV header names and the column names they land under -------------------
ARTWORK_HEADERS = {
    "Title": "title",
    "Artist": "artist",
    "ConstituentID": "constituent_id",
    "ArtistBio": "artist_bio",
    "Nationality": "nationality",
    "BeginDate": "begin_date",
    "EndDate": "end_date",
    "Gender": "gender",
    "Date": "date",
    "Medium": "medium",
    "Dimensions": "dimensions",
    "CreditLine": "credit_line",
    "AccessionNumber": "accession_number",
    "Classification": "classification",
    "Department": "department",
    "DateAcquired": "date_acquired",
    "Cataloged": "cataloged",
    "ObjectID": "object_id",
    "URL": "url",
    "ImageURL": "image_url",
    "OnView": "on_view",
    "Circumference (cm)": "circumference_cm",
    "Depth (cm)": "depth_cm",
    "Diameter (cm)": "diameter_cm",
    "Height (cm)": "height_cm",
    "Length (cm)": "length_cm",
    "Weight (kg)": "weight_kg",
    "Width (cm)": "width_cm",
    "Seat Height (cm)": "seat_height_cm",
    "Duration (sec.)": "duration_sec",
}
ARTIST_HEADERS = {
    "ConstituentID": "constituent_id",
    "DisplayName": "display_name",
    "ArtistBio": "artist_bio",
    "Nationality": "nationality",
    "Gender": "gender",
    "BeginDate": "begin_date",
    "EndDate": "end_date",
    "Wiki QID": "wiki_qid",
    "ULAN": "ulan",
}

# --- Fixed values: creation-date prefixes (case-sensitive) and accepted year range ---------
CIRCA_PREFIXES = ("c.", "ca.", "published", "printed")
DATED_PREFIXES = (
    "early", "late", "Summer", "November", "May", "March", "June",
    "January", "February", "December", "August", "April", "October", "September",
)
RANGE_MAX_LENGTH = 10
CREATION_YEARS = (1000, 2024)
LIFE_YEARS = (1000, 2025)

# --- Fixed values: acquisition methods, strongest first, with the patterns that select them
ACQUISITION_PATTERNS = (
    ("Exchange", ("exchange",)),
    ("Bequest", ("bequest",)),
    ("Purchase", ("purchase",)),
    ("Gift", ("gift", "louis e. stern", "fund for the twenty-first century", "given")),
)
ACQUISITION_DEFAULT = "Unknown"

# --- Fixed values: spellings of gender and of a true flag ----------------------------------
GENDER_SPELLINGS = {
    "Male": ("male", "m", "(male)"),
    "Female": ("female", "f", "(female)"),
    "Non-binary": (
        "non-binary", "nonbinary", "nb", "gender non-conforming", "transgender woman",
        "female transwoman",
    ),
}
TRUE_SPELLINGS = ("Y", "YES", "TRUE", "1")
UNKNOWN = "Unknown"
UNASSIGNED_CLASSIFICATION = "(not assigned)"

# --- Fixed values: weights of the completeness scores (hundredths) -------------------------
ARTWORK_WEIGHTS = {
    "title": 15, "creation_date": 25, "acquisition_date": 15,
    "dimensions": 20, "classification": 15, "cataloged": 10,
}
ARTIST_WEIGHTS = {
    "birth_year": 20, "nationality": 20, "gender": 15,
    "display_name": 15, "death_or_living": 10, "enrichment": 20,
}

# --- Fixed values: report tiers over those scores (lower bound in hundredths) --------------
QUALITY_TIERS = (
    (80, "Excellent (0.8-1.0)"),
    (60, "Good (0.6-0.8)"),
    (40, "Fair (0.4-0.6)"),
)
LOWEST_TIER = "Poor (0.0-0.4)"

# --- Fixed values: historical eras by last year --------------------------------------------
ERAS = (
    (1913, "Gilded Age (rapid industrialisation & economic growth)"),
    (1918, "WWI"),
    (1928, "Roaring Twenties"),
    (1939, "Great Depression"),
    (1945, "WWII"),
    (1960, "Post-War Boom"),
    (1975, "Cold War"),
    (1990, "Postmodern"),
    (2007, "Digital Age"),
)
LATEST_ERA = "Contemporary"
WAR_ERAS = ("WWI", "WWII")

# --- Fixed values: recession year ranges (inclusive) ---------------------------------------
RECESSIONS = (
    (1929, 1939), (1945, 1945), (1949, 1949), (1953, 1954), (1957, 1958), (1960, 1961),
    (1969, 1970), (1973, 1975), (1980, 1982), (1990, 1991), (2001, 2001), (2007, 2009),
    (2020, 2020),
)
RECESSION, EXPANSION = "Recession", "Expansion"

# --- Fixed values: years with a major event ------------------------------------------------
MAJOR_EVENTS = {
    1929: "Stock Market Crash, Great Depression begins",
    1933: "New Deal programs begin",
    1939: "World War II begins",
    1941: "US enters World War II",
    1945: "World War II ends",
    1950: "Korean War begins",
    1953: "Korean War ends",
    1964: "Vietnam War escalates",
    1973: "Oil Crisis, OPEC embargo",
    1975: "Vietnam War ends",
    1987: "Black Monday stock market crash",
    1991: "Gulf War",
    2001: "September 11 attacks, dot-com bubble burst",
    2003: "Iraq War begins",
    2007: "Subprime mortgage crisis begins",
    2008: "Financial crisis, Lehman Brothers collapse",
    2010: "European debt crisis",
    2020: "COVID-19 pandemic begins",
    2022: "russia-Ukraine war, high inflation",
}

# --- Fixed values: economic series (name of the series -> column) and default year spine ---
SERIES_COLUMNS = {
    "GDP": "gdp_usd_billions",
    "CPI": "cpi",
    "Unemployment": "unemployment_rate_percent",
    "SP500": "sp500_close",
}
YEAR_SPINE = (1929, 2024)
ECONOMIC_SOURCE = "Federal Reserve Economic Data (FRED)"

# --- Fixed values: countries whose nationality does not follow the suffix rule -------------
NATIONALITIES = {
    "Czechia": "czech",
    "United States": "american",
    "United Kingdom": "british",
    "Netherlands": "dutch",
    "Switzerland": "swiss",
    "Germany": "german",
    "France": "french",
    "Italy": "italian",
    "Spain": "spanish",
    "Portugal": "portuguese",
    "Poland": "polish",
    "China": "chinese",
    "Japan": "japanese",
    "Vietnam": "vietnamese",
    "Thailand": "thai",
    "Greece": "greek",
    "Sweden": "swedish",
    "Norway": "norwegian",
    "Denmark": "danish",
    "Finland": "finnish",
    "Iceland": "icelandic",
    "Ireland": "irish",
    "Belgium": "belgian",
    "Hungary": "hungarian",
    "Slovakia": "slovak",
    "Ukraine": "ukrainian",
    "Belarus": "belarusian",
    "Turkey": "turkish",
    "Pakistan": "pakistani",
    "Bangladesh": "bangladeshi",
    "Iran": "iranian",
    "Iraq": "iraqi",
    "Israel": "israeli",
    "Egypt": "egyptian",
    "Morocco": "moroccan",
    "Kenya": "kenyan",
    "Mexico": "mexican",
    "Brazil": "brazilian",
    "Argentina": "argentine",
    "Chile": "chilean",
    "Peru": "peruvian",
    "New Zealand": "new zealander",
    "Kazakhstan": "kazakh",
    "Azerbaijan": "azerbaijani",
    "Canada": "canadian",
    "South Korea": "korean",
    "Uruguay": "uruguayan",
    "Scotland": "scottish",
    "Haiti": "haitian",
    "Puerto Rico": "puerto rican",
    "Canada (Inuit regions)": "canadian inuit",
    "Lebanon": "lebanese",
    "Zimbabwe": "zimbabwean",
    "Democratic Republic of the Congo": "congolese",
    "Bosnia and Herzegovina": "bosnian",
    "Palestine": "palestinian",
    "Senegal": "senegalese",
    "Czechoslovakia": "czechoslovakian",
    "Taiwan": "taiwanese",
    "Niger": "nigerien",
    "Philippines": "filipino",
    "North Macedonia": "macedonian",
    "Panama": "panamanian",
    "Wales": "welsh",
    "Sudan": "sudanese",
    "Luxembourg": "luxembourger",
    "Mali": "malian",
    "Singapore": "singaporean",
    "Ghana": "ghanaian",
    "El Salvador": "salvadoran",
    "Paraguay": "paraguayan",
    "Catalonia": "catalan",
    "Bahamas": "bahamian",
    "Mozambique": "mozambican",
    "England": "english",
    "Trinidad and Tobago": "trinidad and tobagonian",
    "Kyrgyzstan": "kyrgyz",
    "Afghanistan": "afghan",
    "United Arab Emirates": "emirati",
}
COUNTRY_SOURCE = "REST Countries API v3.1"
UNKNOWN_COUNTRY = {
    "country_name": "Nationality unknown",
    "country_code_iso2": "XX",
    "country_code_iso3": "XXX",
    "continent": "Unknown",
    "region": "Unknown",
    "subregion": "Unknown",
    "source": "Custom mapping",
}

# --- Fixed values: enrichment requests, statuses and the unknown artist member -------------
REQUEST_BATCH_SIZE = 50
ENTITY_PREFIX = "wd:"
MISSING_IDS = ("", "None")
UNKNOWN_ARTIST_ID = 0
UNKNOWN_ARTIST_NAME = "Unknown Artist"
CONTEMPORARY_YEARS = 20

# --- Fixed values: smallest row counts the transformed layer must reach --------------------
MINIMUM_ROWS = {"transformed_artworks": 100_000, "transformed_artists": 10_000, "bridge_artwork_artist": 1}

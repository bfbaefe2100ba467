"""Values that results depend on, kept in one place as plain text."""

# Word lists, lookup tables, constants and formats.  Changing one changes
# results, so every operator takes them as default arguments.

# --- rating prior and review-text vocabulary ---------------------------------
PRIOR_MEAN = 4.0
PRIOR_STRENGTH = 20.0

ASPECTS = {
    "service": ["service", "staff", "server", "waiter", "waitress", "friendly", "rude", "attentive", "helpful"],
    "wait": ["wait", "waited", "slow", "quick", "fast", "line", "lineup", "reservation"],
    "cleanliness": ["clean", "dirty", "hygiene", "spotless", "filthy", "tidy"],
    "value": ["price", "expensive", "cheap", "value", "worth", "overpriced", "affordable"],
}
COMPLAINT_WORDS = ["never", "worst", "rude", "dirty", "cold", "wrong", "refund", "disappointed", "awful", "terrible"]
POSITIVE_FROM = 0.05
NEGATIVE_UPTO = -0.05

# --- pillars -----------------------------------------------------------------
PILLARS = ["satisfaction", "service", "popularity", "digital", "search", "ai"]
PILLAR_WEIGHTS = {
    "satisfaction": 0.30, "service": 0.20, "popularity": 0.15,
    "digital": 0.15, "search": 0.10, "ai": 0.10,
}
PILLAR_LABELS = {
    "satisfaction": "customer_satisfaction", "service": "service_quality",
    "popularity": "popularity", "digital": "digital_presence",
    "search": "search_visibility", "ai": "ai_visibility",
}

# --- metric vocabulary: key -> source stamped on the row -----------------------
METRIC_SOURCES = {
    "google.rating": "google_places",
    "google.review_count": "google_places",
    "google.rating_bayes": "google_places",
    "yelp.rating": "yelp",
    "yelp.review_count": "yelp",
    "yelp.rating_bayes": "yelp",
    "sat.cross_rating": "combined",
    "sat.consistency": "combined",
    "nlp.service_sentiment": "nlp",
    "nlp.wait_sentiment": "nlp",
    "nlp.cleanliness_sentiment": "nlp",
    "nlp.value_sentiment": "nlp",
    "nlp.complaint_rate": "nlp",
    "nlp.overall_sentiment": "nlp",
    "nlp.review_recency_days": "nlp",
    "pop.review_volume": "combined",
    "pop.cross_platform": "combined",
    "pop.reddit_mentions": "reddit",
    "pop.web_mentions": "web_search",
    "digital.has_website": "combined",
    "digital.seo_score": "firecrawl",
    "search.authority": "semrush",
    "search.organic_traffic": "semrush",
    "search.organic_keywords": "semrush",
    "search.serp_score": "web_search",
    "ai.mentioned": "ai_search",
}

# --- name normalisation --------------------------------------------------------
SIGNAL_STOP_WORDS = ["the", "inc", "ltd", "llc", "co", "corp", "restaurant", "cafe", "bar", "shop", "store"]
PLATFORM_STOP_WORDS = ["the", "inc", "ltd", "co", "cafe", "coffee", "bar", "shop", "restaurant", "company"]
TOPIC_STOP_WORDS = [
    "best", "in", "the", "of", "a", "and", "on", "shop", "store", "restaurant",
    "for", "your", "near", "me", "toronto", "ontario", "canada",
]
QUERY_SUFFIX = ", Ontario, Canada"

# --- place types ---------------------------------------------------------------
FOOD_TYPES = [
    "restaurant", "cafe", "coffee_shop", "bakery", "bar", "pub", "wine_bar",
    "meal_takeaway", "meal_delivery", "fast_food_restaurant", "sandwich_shop",
    "ice_cream_shop", "dessert_shop", "donut_shop", "juice_shop", "tea_house",
    "brewery", "night_club", "banquet_hall", "food", "deli", "diner",
]
KEYWORD_TYPES = {
    "bubble tea": ["cafe", "tea_house", "coffee_shop"],
    "hair salon": ["hair_salon", "beauty_salon", "hair_care"],
    "fine dining": FOOD_TYPES,
    "ice cream": ["ice_cream_shop"],
    "driving school": ["driving_school", "school"],
    "driving instructor": ["driving_school", "school"],
    "wedding hall": ["banquet_hall", "event_venue", "wedding_venue"],
    "farmers market": ["market", "grocery_store"],
    "walk-in clinic": ["doctor", "hospital", "medical_clinic"],
    "auto detailing": ["car_repair", "car_wash"],
    "coffee": ["coffee_shop", "cafe", "bakery"],
    "espresso": ["coffee_shop", "cafe"],
    "roaster": ["coffee_shop", "cafe"],
    "pastry": ["bakery", "cafe"],
    "biscotti": ["bakery", "cafe"],
    "bakery": ["bakery"],
    "dessert": ["bakery", "dessert_shop", "ice_cream_shop", "cafe"],
    "gelato": ["ice_cream_shop"],
    "cheese": ["store", "grocery_store", "deli"],
    "brewery": ["brewery", "bar", "liquor_store"],
    "karaoke": ["karaoke", "bar", "night_club"],
    "barber": ["barber_shop", "hair_care"],
    "salon": ["hair_salon", "beauty_salon", "hair_care"],
    "spa": ["spa", "beauty_salon"],
    "yoga": ["yoga_studio", "gym"],
    "fitness": ["gym", "fitness_center"],
    "dentist": ["dentist"],
    "clinic": ["doctor", "hospital", "medical_clinic"],
    "daycare": ["child_care_agency", "preschool"],
    "mechanic": ["car_repair"],
    "plumber": ["plumber"],
    "electrician": ["electrician"],
    "locksmith": ["locksmith"],
    "mover": ["moving_company"],
    "moving": ["moving_company"],
    "groomer": ["pet_store", "veterinary_care", "pet_groomer"],
    "bookstore": ["book_store"],
    "vintage": ["store", "clothing_store", "thrift_store"],
    "hardware": ["hardware_store", "home_goods_store"],
}
FOOD_CATEGORIES = ["food", "drink", "nightlife"]
DENIED_TYPES = [
    "museum", "tourist_attraction", "art_gallery", "park", "national_park",
    "subway_station", "transit_station", "train_station", "light_rail_station",
    "bus_station", "university", "library", "place_of_worship", "stadium",
    "city_hall", "local_government_office", "courthouse", "primary_school",
    "secondary_school", "airport", "parking",
]

# --- geography, limits, formats --------------------------------------------------
EARTH_RADIUS_M = 6371000.0
DEFAULT_RADIUS_M = 4000
RADIUS_FACTOR = 1.5
MATCH_RADIUS_M = 1000.0
TOPIC_DEPTH = 25
SNIPPETS_PER_BUSINESS = 6
SNIPPET_CHARS = 200
SNIPPET_LONGER_THAN = 20
STRENGTH_BULLETS = 5
CSV_FIELDS = [
    "topic_slug", "rank_position", "final_score", "presence_score",
    "name", "slug", "place_id", "website", "address", "lat", "lng",
    "phone", "photo_url", "rating", "rating_count", "strengths",
]
MERGE_FIELDS = ["place_id", "yelp_id", "website", "domain", "lat", "lng", "address", "phone"]

# What a website audit looks for in a page's markup.
SCHEMA_TYPE = r'"@type"\s*:\s*"([^"]+)"'
HEADING = r"<h1[\s>]"
PAGE_MARKS = {
    "has_open_graph": ['property="og:', "property='og:"],
    "has_viewport": ['name="viewport"'],
    "has_canonical": ['rel="canonical"'],
}

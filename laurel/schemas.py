"""Table and payload schemas (DDL strings)."""

REGIONS = ("slug string, name string, parent_slug string, center_lat double, center_lng double, "
           "search_radius_m int, is_neighbourhood boolean")
TOPICS = ("slug string, title string, description string, category string, region_slug string, "
          "hot_score double, included boolean, search_query string")
CANDIDATES = ("topic_slug string, source_order int, pos int, place_id string, yelp_id string, name string, "
              "address string, lat double, lng double, phone string, website string, domain string, "
              "category string, discovered_via string, discovery_query string")
BUSINESSES = ("business_id string, place_id string, yelp_id string, name string, address string, lat double, "
              "lng double, phone string, website string, domain string, canonical_category string, "
              "first_seen_run string, last_seen_run string, created_at timestamp, photo_url string")
BUSINESS_TOPICS = ("business_id string, topic_slug string, run_id string, discovered_via string, "
                   "discovery_query string, distance_m double, created_at timestamp")
# topic_slug is null for signals about the business itself
RAW = ("business_id string, topic_slug string, source string, run_id string, collected_at timestamp, payload string")
METRICS = ("business_id string, topic_slug string, run_id string, metric_key string, value double, "
           "source string, meta map<string,string>")
PILLAR_SCORES = ("business_id string, topic_slug string, run_id string, pillar string, raw_score double, "
                 "normalized_score double")
RANKINGS = ("topic_slug string, business_id string, run_id string, final_score double, rank_position int, "
            "pillar_breakdown map<string,double>, strengths array<string>, created_at timestamp")

CATALOG = (
    "regions array<struct<slug:string,name:string,parent_slug:string,center_lat:double,center_lng:double,"
    "search_radius_m:int,is_neighbourhood:boolean>>, "
    "topics array<struct<slug:string,title:string,description:string,category:string,region_slug:string,"
    "hot_score:double,included:boolean,search_query:string>>"
)

# One payload schema per landed source.
PAYLOADS = {
    "google_places": ("rating double, userRatingCount long, websiteUri string, "
                      "reviews array<struct<text:string,publishTime:string>>"),
    "yelp": "id string, rating double, review_count long, reviews array<struct<text:string>>",
    "site": "website string",
    "firecrawl": ("fetched boolean, url string, title string, description string, summary string, h1_count long, "
                  "word_count long, has_schema_org boolean, schema_types array<string>, has_open_graph boolean, "
                  "has_viewport boolean, has_canonical boolean, is_https boolean, status long"),
    "semrush": ("domain string, available boolean, organic_keywords double, organic_traffic double, "
                "organic_cost double, authority_score double, backlinks double, ref_domains double"),
    "reddit": ("count long, results array<struct<title:string,score:long,num_comments:long,url:string,"
               "created_utc:double>>"),
    "web_search": "query_results long, serp_rank long, mentioned boolean",
    "ai_search": "mentioned boolean, recommended array<string>",
}

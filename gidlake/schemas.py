"""Schemas and allowed values of the project/company domain."""

from __future__ import annotations

# The enum vocabularies of the data model.
DATA_SOURCES = ["api", "relationships", "scraper", "url_file"]
PROCESSING_STAGES = ["discovered", "assembling", "assembled", "failed", "completed"]
RELATIONSHIP_TYPES = ["jv", "option", "nsr", "operator"]



FEED_DDL = """
  gid string, project_name string, location string,
  centroid struct<coordinates: array<double>>,
  mineral_district_camp string, mineral_district string, area_m2 string,
  stage string, commodities string, operator string
"""

# One entry of a relationship list; every value as text, since numbers may arrive quoted.
EDGE_ENTRY_DDL = """
  id string, company_name string, percentage string, projectCompanyOwnership string, projectCompanyNsr string,
  projectcompanyoptions string, optionee string, comments string, root_ticker string, exchange string,
  website string, ceo string, headquarters string, phone string, industry string, sector string
"""

LOCATION_DDL = """
  location_string string, latitude double, longitude double, country string, state string,
  mineral_district string, area_m2 string, geocoded boolean, location_source string,
  postcode string, iso3166_2 string, county string, territory string
"""

LOCATION_FIELDS = [entry.split()[0] for entry in LOCATION_DDL.split(",")]

COMPANY_DDL = """
  id string, name string, ticker string, exchange string, website string, ceo string,
  headquarters string, phone string, industry string, sector string,
  ownership_percentage double, relationship_type string, data_source string, fetched_at timestamp_ntz
"""

RELATIONSHIP_DDL = f"""
  company_id string, company_name string, relationship_type string, percentage double,
  ownership_id bigint, optionee_id bigint, comments string,
  company_details struct<{COMPANY_DDL.strip()}>, data_source string
"""

PROJECT_DDL = f"""
  gid string, name string, location struct<{LOCATION_DDL.strip()}>, stage string, commodities string,
  operator string, company_relationships array<struct<{RELATIONSHIP_DDL.strip()}>>,
  primary_company struct<{COMPANY_DDL.strip()}>, stakeholders array<struct<{COMPANY_DDL.strip()}>>,
  data_sources array<string>, processing_stage string, project_url string,
  created_at timestamp_ntz, updated_at timestamp_ntz, errors array<string>
"""

COMPANY_DOC_DDL = f"""
  company_id string, company_name string, company_url string, countries array<string>,
  total_projects bigint, part int, parts int, projects array<struct<{PROJECT_DDL.strip()}>>,
  additional_company_data struct<company_info: struct<{COMPANY_DDL.strip()}>,
    enrichment_source: string, api_response_timestamp: timestamp_ntz>
"""

ADDRESS_DDL = """
  state string, state_district string, region string, province string, territory string,
  country string, postcode string, county string,
  `ISO3166-2-lvl4` string, `ISO3166-2-lvl6` string
"""

GEOCODE_DDL = f"lat string, lon string, address struct<{ADDRESS_DDL.strip()}>"

METRICS_DDL = """
  total_projects bigint, completed_projects bigint, failed_projects bigint, skipped_projects bigint,
  api_projects bigint, scraped_projects bigint, relationships_enriched bigint,
  start_time timestamp_ntz, end_time timestamp_ntz, error_summary map<string,bigint>,
  duration_seconds double, success_rate double
"""

LINK_DDL = """
  id bigint, company_id bigint, file_title string, file_name string, file_data string, date_created string
"""

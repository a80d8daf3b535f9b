"""Failure codes carried by response rows, and their wording."""

from __future__ import annotations

EMPTY_URL = "EMPTY_URL"
INVALID_URL = "INVALID_URL"
ENGINE_UNKNOWN = "ENGINE_UNKNOWN"
ENGINE_UNAVAILABLE = "ENGINE_UNAVAILABLE"
ENGINE_EXCEPTION = "ENGINE_EXCEPTION"
NO_ENGINE_CONFIGURED = "NO_ENGINE_CONFIGURED"
ALL_ENGINES_FAILED = "ALL_ENGINES_FAILED"
UNCAUGHT = "UNCAUGHT"
FETCH_EMPTY = "FETCH_EMPTY"
CSS_NO_MATCH = "CSS_NO_MATCH"
EXTRACT_NONE = "EXTRACT_NONE"
CONTENT_EMPTY = "CONTENT_EMPTY"
RENDER_FAILED = "RENDER_FAILED"
RENDER_NO_CONTENT = "RENDER_NO_CONTENT"
NO_INPUT = "NO_INPUT"
NO_URL_FOUND = "NO_URL_FOUND"
NO_VALID_URL = "NO_VALID_URL"
ALL_FAILED = "ALL_FAILED"

# Messages that do not depend on the row. Messages that quote a selector, an engine name or a
# status code are built next to the operator that raises them.
MESSAGES = {
    EMPTY_URL: "URL is empty",
    INVALID_URL: "URL must start with http:// or https:// and name a host",
    NO_ENGINE_CONFIGURED: "no engine is configured",
    FETCH_EMPTY: "no page content was captured for this URL",
    EXTRACT_NONE: "nothing could be extracted from the page",
    CONTENT_EMPTY: "the extracted content is empty",
    RENDER_FAILED: "the page could not be rendered",
    RENDER_NO_CONTENT: "the rendered page has no usable content",
    NO_INPUT: "Please give at least one URL.",
    NO_URL_FOUND: "The input contains no URL.",
    NO_VALID_URL: "The input contains no valid URL (http:// or https:// and a host are required).",
}

UNKNOWN_ERROR = "unknown error"
UNTITLED = "(untitled)"
NO_RESULTS = "No results."
ALL_FAILED_PREFIX = "All URLs failed: "
FAILED_SECTION = "\n\n--- Failed URLs ---\n"

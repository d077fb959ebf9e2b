"""parcelscope subpackage."""

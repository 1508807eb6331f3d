"""geoloom.sources"""

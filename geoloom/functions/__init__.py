"""geoloom.functions"""

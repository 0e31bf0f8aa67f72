"""newsmill.operators"""

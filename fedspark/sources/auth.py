"""Credentials.  Secrets stay in a file only the driver's user can read; tables name the file."""

from __future__ import annotations

import base64
import json
import os
import tempfile
import threading
import time
import urllib.parse
import urllib.request

from ..errors import AuthError, ConfigError

EARLY = 60.0


class Auth:
    """Headers and query parameters for a request.

    Kinds, in order of precedence when several are given: OAuth2 (client_credentials,
    password, authorization_code, refresh_token), API key, basic, bearer token (JWT).
    """

    def __init__(self, options: dict):
        self.o = {k: v for k, v in options.items() if v is not None}
        self._lock = threading.Lock()
        self._token, self._until, self.refresh_token = self.o.get("oauth_token"), float("inf"), self.o.get("oauth_refresh_token")
        self.on_refresh = None
        if "oauth_token_url" in self.o:
            self.kind = "oauth2"
            if self.o.get("oauth_grant") == "password" and not {"username", "password"} <= self.o.keys():
                raise ConfigError("the password grant needs username and password")
        elif "api_key" in self.o:
            self.kind = "api_key"
        elif {"username", "password"} <= self.o.keys():
            self.kind = "basic"
        elif "token" in self.o:
            self.kind = "bearer"
        else:
            self.kind = "none"

    def __getstate__(self):
        """What goes along with a scan: everything but the lock and the listener."""
        return {k: v for k, v in self.__dict__.items() if k not in ("_lock", "on_refresh")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._lock, self.on_refresh = threading.Lock(), None

    def renew(self) -> bool:
        """Forget a token that was refused; whether another can be had."""
        if self.kind != "oauth2":
            return False
        self._token = None
        return True

    def headers(self) -> dict[str, str]:
        if self.kind == "oauth2":
            return {"Authorization": f"Bearer {self.access_token()}"}
        if self.kind == "api_key" and not self.o.get("api_key_param"):
            prefix = self.o.get("api_key_prefix")
            return {self.o.get("api_key_header", "X-API-Key"): f"{prefix} {self.o['api_key']}" if prefix else self.o["api_key"]}
        if self.kind == "basic":
            return {"Authorization": "Basic " + base64.b64encode(f"{self.o['username']}:{self.o['password']}".encode()).decode()}
        if self.kind == "bearer":
            return {"Authorization": f"Bearer {self.o['token']}"}
        return {}

    def parameters(self) -> dict[str, str]:
        return {self.o["api_key_param"]: self.o["api_key"]} if self.kind == "api_key" and self.o.get("api_key_param") else {}

    def authorization_url(self, redirect: str, state: str | None = None) -> str:
        q = {"response_type": "code", "client_id": self.o["oauth_client_id"], "redirect_uri": redirect, "scope": self.o.get("oauth_scope"), "state": state}
        return self.o["oauth_authorize_url"] + "?" + urllib.parse.urlencode({k: v for k, v in q.items() if v})

    def exchange_code(self, code: str, redirect: str) -> str:
        return self._fetch({"grant_type": "authorization_code", "code": code, "redirect_uri": redirect})

    def access_token(self) -> str:
        if self._token and time.time() < self._until - EARLY:
            return self._token
        with self._lock:
            if self._token and time.time() < self._until - EARLY:
                return self._token
            if self.refresh_token:
                try:
                    return self._fetch({"grant_type": "refresh_token", "refresh_token": self.refresh_token})
                except AuthError:
                    self.refresh_token = None
            grant = self.o.get("oauth_grant", "client_credentials")
            form = {"grant_type": grant, "scope": self.o.get("oauth_scope")}
            if grant == "password":
                form |= {"username": self.o["username"], "password": self.o["password"]}
            return self._fetch(form)

    def _fetch(self, form: dict) -> str:
        form = {k: v for k, v in (form | {"client_id": self.o.get("oauth_client_id"), "client_secret": self.o.get("oauth_client_secret")}).items() if v}
        try:
            with urllib.request.urlopen(urllib.request.Request(self.o["oauth_token_url"], urllib.parse.urlencode(form).encode()), timeout=30) as r:
                got = json.loads(r.read())
        except (OSError, ValueError) as e:
            raise AuthError("no token from the authorization server", suggestion="check client id, secret and grant") from e
        self._token, self.refresh_token = got["access_token"], got.get("refresh_token", self.refresh_token)
        self._until = time.time() + float(got.get("expires_in", 3600))
        if self.on_refresh:
            self.on_refresh(got)
        return self._token


def keep_secret(options: dict) -> str:
    """Store credentials in a private file and return its path, which may stand in table options."""
    fd, path = tempfile.mkstemp(prefix="fedspark-secret-", suffix=".json")
    with os.fdopen(fd, "w") as f:  # mkstemp makes it readable by its owner only
        json.dump(options, f)
    return path


def of_file(path: str | None) -> Auth:
    if not path:
        return Auth({})
    with open(path) as f:
        return Auth(json.load(f))
